"""Adding a load to a stored star, so that the result is that of one load of everything.

A star keeps a ledger beside its tables: the records, applicants and trainees as they were before they were linked, and
the junction rows of records that were merged away. A load adds what is new under the next ids, rejects what contradicts
stored rows, and links again only the people whose name occurs among its new applicants, records or trainees.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import slug
from rosterflow.operators.joins import bounded_join, equi_join
from rosterflow.operators.numbering import SYNTHETIC_BASE, number_rows
from rosterflow.plans.linked import linked_records
from rosterflow.session import stage_packed, together

#: what a star keeps beside its tables: records, applicants and trainees before linking, junction rows not in use
RECORDS, PEOPLE, ROSTER = "known_records", "known_people", "known_roster"
SPARE = {
    "strengths_junction": "spare_strengths",
    "weaknesses_junction": "spare_weaknesses",
    "tech_junction": "spare_scores",
}
LEDGER = (RECORDS, PEOPLE, ROSTER, *SPARE.values())
#: name of the further table that takes the rows left out as they contradict stored ones
REJECTS = "append_rejects"

#: dimensions: id column, natural key
DIMENSIONS = {
    "recruiters": ("recruiter_id", "recruiter_name"),
    "academy_locations": ("academy_location_id", "location_name"),
    "strengths": ("strength_id", "strength"),
    "weaknesses": ("weakness_id", "weakness"),
    "tech_self_scores": ("tech_id", "tech_name"),
    "trainers": ("trainer_id", "trainer"),
}
#: junctions: dimension, its id column
JUNCTIONS = [
    ("strengths_junction", "strengths", "strength_id"),
    ("weaknesses_junction", "weaknesses", "weakness_id"),
    ("tech_junction", "tech_self_scores", "tech_id"),
]
#: what tells a trainee apart: the file without its folder, its course and date, the name, the place among namesakes
IDENTITY = ["file_name", "course_name", "date", "name", "nth"]
_DATE_CHARS = 8


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool = False) -> DataFrame:
    """Join to a written table, whose size Spark knows from its files; only what it would broadcast is measured."""
    return bounded_join(left, right, on, how, null_safe)


def name_group(person: Column) -> Column:
    """The part of an applicant or person id that comes from the name; all that is linked to a person shares it."""
    return F.substring(person, F.lit(1), F.greatest(F.char_length(person) - _DATE_CHARS, F.lit(0)))


def roster_with_identity(trainees: DataFrame) -> DataFrame:
    """Trainees with ``nth``, their place among those of equal name, file, course and date.

    Counted from one numbering over all, so that a name without value, or one that many share, is not one task's work.
    """
    others = IDENTITY[:-1]
    order = [F.col(c).asc_nulls_first() for c in others]
    numbered = stage_packed(number_rows(trainees, [*order, "trainee_id"], "_row"), "roster")
    firsts = numbered.groupBy(*others).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = stage_packed(firsts.where("_n > 1").drop("_n"), "roster-firsts")
    placed = lookup(numbered, firsts, others, "left", null_safe=True)
    return placed.withColumn("nth", F.coalesce(F.col("_row") - F.col("_first"), F.lit(0))).drop("_row", "_first")


def ledger(
    records: DataFrame, people: DataFrame, order: list[str], roster: DataFrame, talent: DataFrame, pairs: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """The further tables of a star; ``pairs`` are its junction rows before those of unknown records are left out."""
    kept = ["trainee_id", "trainer_id", *IDENTITY]
    keys = stage_packed(talent.select("json_key").where(F.col("json_key").isNotNull()).distinct(), "ledger-keys")
    spare = {SPARE[n]: lookup(df, keys, ["json_key"], "left_anti") for n, df in pairs.items()}
    return {
        RECORDS: records,
        PEOPLE: people.select(*order, "applicant_id", "name", "invited_date"),
        ROSTER: roster_with_identity(roster).select(*kept),
        **spare,
    }


def continue_star(stored: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables and ledger of ``stored`` with the load ``new``, and a further table REJECTS (see ``star_parts``)."""
    return {name: reduce(DataFrame.unionByName, parts) for name, parts in star_parts(stored, new).items()}


def star_parts(stored: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, list[DataFrame]]:
    """The tables of ``continue_star`` as parts: a table that only grows is the stored one, unchanged, and the new rows.

    REJECTS has the columns source, record, reason.

    Stored rows keep their ids and win: of a new row whose natural key is stored, only what is missing there is taken,
    and what differs goes to the rejects. Natural keys are names in dimensions, applicant_id, the code of a course, the
    person id of a record, record and value in junctions, trainee and week in marks, and IDENTITY for trainees, so
    people who share a trainer and course stay apart. Records keep their file's number, and keyless ones the key
    made for them, as long as they are not merged. Loading the same again changes nothing.
    """
    missing = [n for n in LEDGER if n not in stored or n not in new]
    if missing:
        raise ValueError(f"both sides need the ledger of build_star: {', '.join(missing)}")
    spark = stored["talent"].sparkSession
    out, rejects = {}, []
    found = together(spark, *(partial(_continued, n, stored[n], new[n], *keys) for n, keys in DIMENSIONS.items()))
    ids = {}
    for name, (rows, mapped) in zip(DIMENSIONS, found):
        out[name], ids[name] = _grown(stored[name], rows), mapped

    def keyed(name: str, rows: DataFrame, natural: list[str], key: str | None = None) -> DataFrame:
        fresh, differing = _added(name, stored[name], rows, natural, key)
        out[name] = _grown(stored[name], fresh)
        rejects.append(differing)
        return fresh

    def add_trainees() -> DataFrame:
        fresh, roster_ids, differing = _trainees(stored, new, ids["trainers"])
        out[ROSTER] = _grown(stored[ROSTER], fresh.drop("_before"))
        rejects.append(differing)
        marks = _mapped(new["behaviours"], roster_ids, "trainee_id", "inner")
        keyed("behaviours", marks, ["trainee_id", "week_number"], "behaviour_id")
        return fresh

    def add_records() -> DataFrame:
        rows = _mapped(new[RECORDS], ids["academy_locations"], "academy_location_id")
        merged, fresh, differing = _records(stored[RECORDS], rows)
        out[RECORDS] = [stored[RECORDS] if fresh.isEmpty() else merged]
        rejects.append(differing)
        return fresh

    def add_pairs(name: str, dim: str, column: str) -> DataFrame:
        columns, spare = stored[name].columns, SPARE[name]
        rows = _mapped(new[name].select(*columns).unionByName(new[spare].select(*columns)), ids[dim], column)
        old = stored[name].unionByName(stored[spare].select(*columns))
        fresh, differing = _added(name, old, rows, ["json_key", column], None)
        rejects.append(differing)
        return fresh

    people = stored[PEOPLE].columns
    fresh_roster, fresh_records, (fresh_people, _), *fresh_pairs, _, _, _ = together(
        spark,
        add_trainees,
        add_records,
        lambda: _added(PEOPLE, stored[PEOPLE], new[PEOPLE], people, None),
        *(partial(add_pairs, *names) for names in JUNCTIONS),
        lambda: keyed("courses", new["courses"], ["course_id"]),
        lambda: keyed("location", new["location"], ["applicant_id", "address", "postcode", "city"], "location_id"),
        lambda: keyed("applicants", _mapped(new["applicants"], ids["recruiters"], "recruiter_id"), ["applicant_id"]),
    )
    out[PEOPLE] = _grown(stored[PEOPLE], fresh_people)
    order = [c for c in people if c not in ("applicant_id", "name", "invited_date")]

    # only people of these names can be linked otherwise than before
    groups = [
        fresh_records.select(name_group(F.col("applicant_id")).alias("_group")),
        fresh_people.select(name_group(F.col("applicant_id")).alias("_group")),
        fresh_roster.select(slug(F.col("name")).alias("_group")),
    ]
    groups = stage_packed(reduce(DataFrame.unionByName, groups).where(F.col("_group").isNotNull()).distinct(), "append-groups")
    out["talent"], out["trainees"] = [stored["talent"]], [stored["trainees"]]
    if not fresh_roster.isEmpty():
        trainees = _mapped(new["trainees"], ids["trainers"], "trainer_id")
        added = fresh_roster.select("_before", F.col("trainee_id").alias("_after"))
        added = _mapped(trainees, added, "trainee_id", "inner").select(*stored["trainees"].columns)
        out["trainees"] = [stored["trainees"], added]
    moved = None
    if not groups.isEmpty():
        whole = {name: reduce(DataFrame.unionByName, out[name]) for name in (RECORDS, PEOPLE, ROSTER, "trainees")}
        talent, links, moved = _linked_again(stored["talent"], whole, groups, order)
        everyone = lookup(whole["trainees"], links, ["trainee_id"], "left")
        key = F.when(F.col("_link").isNotNull(), F.col("_link.json_key")).otherwise(F.col("json_key"))
        out["talent"], out["trainees"] = [talent], [everyone.withColumn("json_key", key).drop("_link")]

    kept = None
    for (name, _, _), fresh in zip(JUNCTIONS, fresh_pairs):
        used, spare = [stored[name]], [stored[SPARE[name]]]
        if moved is not None and not all(keys.isEmpty() for keys in moved):
            gone, come = moved
            used, spare = (
                [lookup(used[0], gone, ["json_key"], "left_anti"), lookup(spare[0], come, ["json_key"], "left_semi")],
                [lookup(spare[0], come, ["json_key"], "left_anti"), lookup(used[0], gone, ["json_key"], "left_semi")],
            )
        if not fresh.isEmpty():
            kept = kept or stage_packed(out["talent"][0].select("json_key"), "append-keys")
            used.append(lookup(fresh, kept, ["json_key"], "left_semi"))
            spare.append(lookup(fresh, kept, ["json_key"], "left_anti"))
        out[name], out[SPARE[name]] = used, spare
    out[REJECTS] = [reduce(DataFrame.unionByName, rejects)]
    return out


def _linked_again(
    stored: DataFrame, tables: dict[str, DataFrame], groups: DataFrame, order: list[str]
) -> tuple[DataFrame, DataFrame, tuple[DataFrame, DataFrame]]:
    """(talent with the people of these groups linked again, their trainees' links, the file keys gone from it and come to it)."""

    def of_groups(rows: DataFrame, group: Column, how: str = "left_semi") -> DataFrame:
        return lookup(rows.withColumn("_group", group), groups, ["_group"], how).drop("_group")

    by_id, by_name = name_group(F.col("applicant_id")), slug(F.col("name"))
    touched = stage_packed(of_groups(tables[ROSTER], by_name), "append-roster")
    final, followed = linked_records(
        stage_packed(of_groups(tables[RECORDS], by_id), "append-records"), of_groups(tables[PEOPLE], by_id), touched, order
    )
    before = stage_packed(of_groups(stored, by_id), "append-before")
    after = stage_packed(_talent(stored, before, stage_packed(final, "append-final")), "append-after")
    links = stage_packed(followed.select("trainee_id", F.struct("json_key").alias("_link")), "append-links")

    # keys that were made have no junction rows
    had, has = (rows.select("json_key").where(F.col("json_key") < SYNTHETIC_BASE) for rows in (before, after))
    gone = stage_packed(lookup(had, has, ["json_key"], "left_anti"), "append-gone")
    come = stage_packed(lookup(has, had, ["json_key"], "left_anti"), "append-come")
    # a key that records of other groups hold as well is not gone
    counted = stored.select("json_key", F.lit(1).alias("_n")).unionByName(had.withColumn("_n", F.lit(-1)))
    counted = lookup(counted, gone, ["json_key"], "left_semi").groupBy("json_key").agg(F.sum("_n").alias("_n"))
    gone = stage_packed(counted.where("_n = 0").select("json_key"), "append-gone-keys")
    return of_groups(stored, by_id, "left_anti").unionByName(after), links, (gone, come)


def _grown(old: DataFrame, fresh: DataFrame) -> list[DataFrame]:
    return [old] if fresh.isEmpty() else [old, fresh]


def _first_id(old: DataFrame, rows: DataFrame, key: str) -> int:
    """The id behind the greatest stored one; where nothing is stored, that at which the load begins."""
    top = old.agg(F.max(F.col(key).cast("long"))).first()[0]
    return int(rows.agg(F.min(F.col(key).cast("long"))).first()[0] or 0) if top is None else top + 1


def _next(old: DataFrame, key: str) -> int:
    top = old.agg(F.max(F.col(key).cast("long"))).first()[0]
    return 1 if top is None else top + 1


def _mapped(rows: DataFrame, ids: DataFrame, column: str, how: str = "left") -> DataFrame:
    """``column`` turned from the load's ids to the stored ones."""
    kind = dict(rows.dtypes)[column]
    mapped = ids.select(F.col("_before").cast(kind).alias(column), F.col("_after").cast(kind).alias("_after"))
    joined = lookup(rows, mapped, [column], how)
    return joined.withColumn(column, F.col("_after")).select(*rows.columns)


def _continued(name: str, old: DataFrame, rows: DataFrame, key: str, natural: str) -> tuple[DataFrame, DataFrame]:
    """(new values of a dimension, ids of the load as _before and _after)."""
    kind = dict(old.dtypes)[key]
    known = old.select(natural, F.col(key).alias("_after"))
    joined = stage_packed(lookup(rows, known, [natural], "left", null_safe=True), f"append-{name}")
    fresh = joined.where("_after IS NULL")
    if name == "academy_locations":
        # no academy is 0 in every load
        none = fresh.where(F.col(natural).isNull()).withColumn("_after", F.lit(0).cast("long"))
        fresh = fresh.where(F.col(natural).isNotNull())
    first = _first_id(old, rows, key)
    first = max(first, 1) if name == "academy_locations" else first
    fresh = stage_packed(number_rows(fresh.drop("_after"), [F.col(key).cast("long")], "_after", first), f"append-new-{name}")
    if name == "academy_locations":
        fresh = fresh.unionByName(none)
    added = fresh.select(F.col("_after").cast(kind).alias(key), natural)
    ids = joined.where("_after IS NOT NULL").select(F.col(key).alias("_before"), F.col("_after").cast("long"))
    ids = ids.unionByName(fresh.select(F.col(key).alias("_before"), "_after"))
    return added.select(*old.columns), stage_packed(ids, f"append-ids-{name}")


def _json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _with_key(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that are never null and equal where ``columns`` are (null equals null), and their names.

    Whole numbers stand for themselves, as they take less room in a shuffle than a digest; others are one digest.
    """
    kinds = dict(df.dtypes)
    if any(kinds[c] not in ("bigint", "int", "smallint", "tinyint") for c in columns):
        return df.withColumn("_key", F.unhex(F.md5(_json(columns)))), ["_key"]
    nulls = reduce(Column.__add__, [F.col(c).isNull().cast("int") * F.lit(1 << n) for n, c in enumerate(columns)])
    keys = {f"_key{n}": F.coalesce(c, F.lit(0).cast(kinds[c])) for n, c in enumerate(columns)}
    return df.withColumns({**keys, "_nulls": nulls}), [*keys, "_nulls"]


def _added(name: str, old: DataFrame, rows: DataFrame, natural: list[str], key: str | None) -> tuple[DataFrame, DataFrame]:
    """(new rows, rejects): rows are new if their natural key is not stored. ``key`` is numbered on.

    Both sides are shuffled once, the stored one as its keys with the least and the greatest digest of their further
    values: these tell rows that are stored alike from those that contradict, unless a key is stored with three or more
    values. Only rows of such keys are compared with all digests. A load without rows is compared with nothing.
    """
    kinds = dict(old.dtypes)
    values = [c for c in old.columns if c != key]
    further = [c for c in values if c not in natural]
    typed = rows.select(*[F.col(c).cast(kinds[c]).alias(c) for c in old.columns])
    load = stage_packed(typed, f"append-load-{name}")
    if load.isEmpty():
        return load, _rejected(name, load, values)
    known, on = _with_key(old.select(*natural, *further), natural)
    given, _ = _with_key(load, natural)
    if further:
        known = known.select(*on, F.xxhash64(_json(further)).alias("_stored"))
        given = given.withColumn("_given", F.xxhash64(_json(further)))
        ends = known.groupBy(*on).agg(F.min("_stored").alias("_least"), F.max("_stored").alias("_most"))
        # the stored keys are dealt out anyway, so they are never broadcast
        met = equi_join(given, ends.hint("merge"), on, "left", False).where("_least IS NULL OR _given NOT IN (_least, _most)")
        other = stage_packed(met, f"append-other-{name}")
        fresh, differing = other.where("_least IS NULL"), other.where("_least = _most")
        unsure = other.where("_least < _most")
        if not unsure.isEmpty():
            several = known.withColumnRenamed("_stored", "_given")
            differing = differing.unionByName(lookup(unsure, several, [*on, "_given"], "left_anti"))
        differing = differing.select(*values)
    else:
        fresh = stage_packed(lookup(given, known.select(*on), on, "left_anti").select(*old.columns), f"append-new-{name}")
        differing = load.where("false")
    fresh = fresh.select(*old.columns)
    if key is not None and not fresh.isEmpty():
        order = [F.col("_before").cast("long")]
        fresh = number_rows(fresh.withColumnRenamed(key, "_before"), order, key, _first_id(old, load, key))
        fresh = fresh.withColumn(key, F.col(key).cast(kinds[key])).select(*old.columns)
    return fresh, _rejected(name, differing, values)


def _rejected(name: str, rows: DataFrame, values: list[str]) -> DataFrame:
    record = F.to_json(F.struct(*values)).alias("record")
    return rows.select(F.lit(name).alias("source"), record, F.lit("contradicts a stored row").alias("reason"))


def _trainees(
    stored: dict[str, DataFrame], new: dict[str, DataFrame], trainers: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new rows of the roster with their id in the load as _before, ids of the load's trainees, rejects)."""
    old = stored[ROSTER]
    rows, on = _with_key(_mapped(new[ROSTER], trainers, "trainer_id"), IDENTITY)
    known, _ = _with_key(old, IDENTITY)
    known = known.select(*on, F.col("trainee_id").alias("_after"), F.col("trainer_id").alias("_trainer"))
    joined = stage_packed(lookup(rows, known, on, "left").drop(*on), "append-trainees")
    found = joined.where("_after IS NOT NULL")
    differing = found.where("NOT (trainer_id <=> _trainer)")
    fresh = joined.where("_after IS NULL").drop("_after", "_trainer").withColumnRenamed("trainee_id", "_before")
    if not fresh.isEmpty():
        fresh = number_rows(fresh, ["_before"], "trainee_id", _next(old, "trainee_id"))
    else:
        fresh = fresh.withColumn("trainee_id", F.col("_before"))
    ids = found.select(F.col("trainee_id").alias("_before"), "_after")
    ids = ids.unionByName(fresh.select("_before", F.col("trainee_id").alias("_after")))
    return fresh.select(*old.columns, "_before"), ids, _rejected("trainees", differing, ["trainer_id", *IDENTITY])


def _records(old: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, those new or changed, rejects). A person's record takes from a later one what it lacks.

    Both sides hold one record per person, so no key is hot in the full join, and each is shuffled once.
    """
    columns = old.columns
    values = [c for c in columns if c != "applicant_id"]
    load = stage_packed(rows.select(*columns).where(F.col("applicant_id").isNotNull()), "append-load")
    if load.isEmpty():
        return old, load, _rejected("talent", load, columns)
    known = _academy(old, None).select("applicant_id", F.struct(*values).alias("_old"))
    given = _academy(load, None).select("applicant_id", F.struct(*values).alias("_new"))
    both = known.join(given, "applicant_id", "full_outer")
    lacked = [F.col(f"_old.{c}").isNull() & F.col(f"_new.{c}").isNotNull() for c in values]
    differs = [F.col(f"_old.{c}").isNotNull() & F.col(f"_new.{c}").isNotNull() & (F.col(f"_old.{c}") != F.col(f"_new.{c}")) for c in values]
    merged = both.select(
        "applicant_id",
        *[F.coalesce(f"_old.{c}", f"_new.{c}").alias(c) for c in values],
        (F.col("_old").isNull() | reduce(Column.__or__, lacked)).alias("_changed"),
        F.when(reduce(Column.__or__, differs), F.col("_new")).alias("_refused"),
    )
    merged = stage_packed(_academy(merged, 0), "append-merged")
    changed = merged.where("_changed").select(*columns)
    refused = merged.where("_refused IS NOT NULL").select("applicant_id", "_refused.*")
    return merged.select(*columns), changed, _rejected("talent", refused, columns)


def _academy(records: DataFrame, none: int | None) -> DataFrame:
    """No academy (0) as null, or the other way round."""
    academy = F.col("academy_location_id")
    value = F.nullif(academy, F.lit(0)) if none is None else F.coalesce(academy, F.lit(none))
    return records.withColumn("academy_location_id", value.cast("long"))


def _talent(stored: DataFrame, before: DataFrame, final: DataFrame) -> DataFrame:
    """Rows of the linked records under the ids they had: by their file's number, then by applicant; others get new ids."""
    columns = stored.columns
    final = final.select(*[c for c in columns if c != "talent_id"])
    named = before.where(F.col("json_key") < SYNTHETIC_BASE).select("json_key", F.col("talent_id").alias("_id"))
    keyed = stage_packed(lookup(final.where("json_key IS NOT NULL"), named, ["json_key"], "left"), "append-by-key")
    taken = keyed.where("_id IS NOT NULL").select(F.col("_id").alias("talent_id"))
    left = lookup(before, taken, ["talent_id"], "left_anti")
    made = F.when(F.col("json_key") >= SYNTHETIC_BASE, F.col("json_key")).alias("_made")
    left = stage_packed(left.select("applicant_id", F.col("talent_id").alias("_other"), made), "append-left")
    rest = keyed.where("_id IS NULL").drop("_id").unionByName(final.where("json_key IS NULL"))
    rest = lookup(rest, left, ["applicant_id"], "left")
    rest = rest.withColumn("json_key", F.coalesce("json_key", "_made")).drop("_made").withColumnRenamed("_other", "_id")
    rest = stage_packed(rest, "append-rest")
    known = keyed.where("_id IS NOT NULL").unionByName(rest.where("_id IS NOT NULL"))

    # new records with a file stand before those without, so one numbering gives the ids and the made keys
    first, first_made = _next(stored, "talent_id"), _next_made(stored)
    fresh = rest.where("_id IS NULL").drop("_id").withColumn("_keyless", F.col("json_key").isNull())
    fresh = number_rows(fresh, ["_keyless", "applicant_id"], "_id", first)
    first_keyless = first + fresh.where("NOT _keyless").count()
    bare = known.where("json_key IS NULL")
    if bare.isEmpty():
        key = F.when(F.col("_keyless"), F.col("_id") - F.lit(first_keyless) + F.lit(first_made)).otherwise(F.col("json_key"))
        fresh = fresh.withColumn("json_key", key.cast("long"))
        rows = known.unionByName(fresh.drop("_keyless"))
    else:
        # records that kept their id and lost their file take their places among them
        rows = known.unionByName(fresh.drop("_keyless"))
        keyless = rows.where("json_key IS NULL").select("applicant_id")
        keyless = stage_packed(number_rows(keyless, ["applicant_id"], "_made", first_made), "append-keyless")
        rows = lookup(rows, keyless, ["applicant_id"], "left").withColumn("json_key", F.coalesce("json_key", "_made").cast("long"))
    return rows.withColumnRenamed("_id", "talent_id").select(*columns)


def _next_made(stored: DataFrame) -> int:
    top = stored.agg(F.max(F.when(F.col("json_key") >= SYNTHETIC_BASE, F.col("json_key")))).first()[0]
    return SYNTHETIC_BASE if top is None else top + 1
