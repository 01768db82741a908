"""CSV files of any layout in one scan: columns are bound by each file's own heading, and nothing is lost.

Files are read as splittable lines with their positions. A quoted value may go on in the next lines. Which lines belong
together is decided from a few numbers per line that hold a quote, split by split; what a split must know of the others
(counts, the next and the last such line) is one row per split, so a file of many splits is read by as many tasks.
Rows that do not fit their heading, and files without the needed columns, come out as rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterflow.operators.joins import lookup
from rosterflow.session import stage
from rosterflow.sources.files import POSITION, file_reader, modified_after, with_file_position
from rosterflow.sources.schemas import MISSING

#: what stands between quotes, quotes inside doubled; possessive, so that no length of a value needs a deep stack
_INSIDE = r'(?:[^"]++|"")*+'
#: a whole value: quoted, or one that does not begin with a quote; and one behind a comma
_WHOLE = rf'(?:"{_INSIDE}"|(?!")[^,]*+)'
_VALUE = f",({_WHOLE})"
#: lines that leave a value open, close one, and close one and leave another open; group 1 holds their whole values
_OPENS = rf'\A((?:{_WHOLE},)*+)"{_INSIDE}\z'
_CLOSES = rf'\A{_INSIDE}"((?:,{_WHOLE})*+)\z'
_REOPENS = rf'\A{_INSIDE}"((?:,{_WHOLE})*+),"{_INSIDE}\z'
#: a quote between two ordinary characters neither opens nor closes a value; the quote comes first, so it is sought first
_LETTER_QUOTE = r'"(?<=[^,"\n]")(?=[^,"\n])'
REJECTS = "source string, src_file string, record string, reason string"
SPLIT = ["src_file", "src_block"]


def scan_lines(spark: SparkSession, folder: str, since=None) -> DataFrame:
    """Lines of all CSV files below a folder with their positions, written once."""
    lines = file_reader(spark, ".csv", since).option("lineSep", "\n").text(folder)
    return stage(with_file_position(modified_after(lines, since)), "csv-lines")


def _quotes(value: Column) -> Column:
    """Quotes that open or close values."""
    plain = F.regexp_replace(value, _LETTER_QUOTE, "")
    return F.char_length(plain) - F.char_length(F.replace(plain, F.lit('"'), F.lit("")))


def _line(value: Column) -> Column:
    """A line without the return at its end."""
    return F.when(value.endswith("\r"), F.left(value, F.char_length(value) - 1)).otherwise(value)


def _is_odd(line: Column) -> Column:
    return F.contains(line, F.lit('"')) & (_quotes(line) % 2 == 1)


def _whole_values(line: Column, pattern: str, one: str) -> Column:
    """Number of whole values of a line of this kind; null for other lines."""
    return F.when(line.rlike(pattern), F.regexp_count(F.regexp_extract(line, pattern, 1), F.lit(one)))


def _turns(lines: DataFrame) -> DataFrame:
    """Lines that may open, close or interrupt a value: opens, closes, reopens (whole values, null if they do not), odd."""
    line = _line(F.col("value"))
    odd = _is_odd(line)
    inside = line.rlike(rf"\A{_INSIDE}\z")
    found = lines.where(F.contains("value", F.lit('"'))).select(
        *POSITION,
        odd.alias("odd"),
        F.when(odd, _whole_values(line, _OPENS, f"{_WHOLE},")).alias("opens"),
        F.when(odd, _whole_values(line, _CLOSES, f",{_WHOLE}")).alias("closes"),
        F.when(~odd, _whole_values(line, _REOPENS, f",{_WHOLE}") + 1).alias("reopens"),
        inside.alias("inside"),
    )
    return found.where("odd OR NOT inside").drop("inside")


def _before(*parts: str, by: str):
    return Window.partitionBy(*parts).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)


def _joints(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """Position and ``open``: whether the line opens a record that goes on, for lines that open, close or interrupt one.

    A line with an odd number of quotes may open a record up to the next such line. It does if all lines between belong
    inside and the record has as many values as the heading; else it stands alone, and so does the line that no record
    closes. Of neighbouring candidates the earlier wins: behind one that fails they take turns.
    """
    inner = Window.partitionBy(*SPLIT).orderBy("src_row")
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    added = F.coalesce(F.sum("reopens").over(upto), F.lit(0))
    main = F.col("odd") | F.col("reopens").isNull()
    turns = stage(_turns(lines).withColumn("added", added).withColumn("main", main), "csv-turns")
    joints = turns.where("main").withColumn("nth", F.row_number().over(inner))

    # one row per split: what stands before it in its file, and the first joint behind it
    first = F.min_by(F.struct("odd", "closes", "added"), F.when(F.col("main"), F.col("src_row")))
    splits = turns.groupBy(*SPLIT).agg(
        F.count_if("main").alias("n"), F.coalesce(F.sum("reopens"), F.lit(0)).alias("more"), first.alias("first")
    )
    earlier = _before("src_file", by="src_block")
    for name, total in (("n_before", "n"), ("more_before", "more")):
        splits = splits.withColumn(name, F.coalesce(F.sum(total).over(earlier), F.lit(0)))
    start = F.when(
        F.col("first").isNotNull(),
        F.struct("first.odd", "first.closes", (F.col("first.added") + F.col("more_before")).alias("added")),
    )
    later = Window.partitionBy("src_file").orderBy(F.desc("src_block")).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("later", F.last(start, ignorenulls=True).over(later))
    splits = stage(splits.select(*SPLIT, "n_before", "more_before", "later"), "csv-splits")

    placed = lookup(joints, splits, SPLIT, "inner").withColumn("added", F.col("added") + F.col("more_before"))
    follower = F.coalesce(F.lead(F.struct("odd", "closes", "added")).over(inner), F.col("later"))
    placed = placed.withColumn("nth", F.col("nth") + F.col("n_before")).withColumn("follower", follower)
    values = F.when(F.col("follower.odd"), F.col("opens") + 1 + F.col("follower.closes") + F.col("follower.added") - F.col("added"))
    placed = lookup(placed.withColumn("n_values", values), heads, ["src_file"], "left")
    is_head = (F.col("src_block") == F.col("head_block")) & (F.col("src_row") == F.col("head_row"))
    # a heading with a line break says itself how many values there are
    own = placed.where(is_head).select("src_file", F.col("n_values").alias("own"))
    placed = stage(placed.withColumn("is_head", is_head), "csv-placed")
    placed = lookup(placed, stage(own, "csv-own"), ["src_file"], "left")
    fits = F.coalesce(F.col("n_values") == F.coalesce("own", "head_values"), F.lit(False))
    placed = placed.withColumn("fits", fits)
    failed = F.max(F.when(~F.col("fits"), F.col("nth")))
    tails = placed.groupBy(*SPLIT).agg(failed.alias("failed"))
    tails = stage(tails.select(*SPLIT, F.max("failed").over(earlier).alias("failed_before")), "csv-failed")
    inside = failed.over(inner.rowsBetween(Window.unboundedPreceding, -1))
    placed = lookup(placed, tails, SPLIT, "inner")
    steps = F.col("nth") - 1 - F.coalesce(inside, "failed_before", F.lit(0))
    return placed.select(*POSITION, (F.col("fits") & (steps % 2 == 0)).alias("open"))


def _records(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """One row per record, at the position of its first line."""
    odd = stage(lines.where(_is_odd(_line(F.col("value")))).select("src_file").distinct(), "csv-quoted")
    if odd.isEmpty():
        return _told(lines)
    plain = lookup(lines, odd, ["src_file"], "left_anti")
    quoted = lookup(lines, odd, ["src_file"], "left_semi")
    joints = stage(_joints(quoted, lookup(heads, odd, ["src_file"], "left_semi")), "csv-joints")

    last = joints.groupBy(*SPLIT).agg(F.max_by(F.struct("open", *POSITION[1:]), "src_row").alias("last"))
    carried = lines.select(*SPLIT).distinct()  # one row per split
    carried = lookup(carried, stage(last, "csv-last"), SPLIT, "left")
    carried = carried.withColumn("carried", F.last("last", ignorenulls=True).over(_before("src_file", by="src_block")))
    touched = carried.where(F.col("last").isNotNull() | F.col("carried.open")).select(*SPLIT, "carried")
    touched = stage(touched, "csv-touched")
    alone = lookup(quoted, touched.select(*SPLIT), SPLIT, "left_anti")

    marked = lookup(lookup(quoted, joints, POSITION, "left"), touched, SPLIT, "inner")
    joint = F.when(F.col("open").isNotNull(), F.struct("open", *POSITION[1:]))
    before = F.coalesce(F.last(joint, ignorenulls=True).over(_before(*SPLIT, by="src_row")), F.col("carried"))
    marked = marked.withColumn("_before", before)
    within = F.coalesce(F.col("_before.open"), F.lit(False))
    marked = marked.withColumn("_within", within).withColumn("_many", within | F.coalesce("open", F.lit(False)))
    marked = stage(marked.select("value", *POSITION, "_before", "_within", "_many"), "csv-marked")
    single = marked.where("NOT _many")
    place = [F.when(F.col("_within"), F.col(f"_before.{c}")).otherwise(F.col(c)).alias(c) for c in POSITION[1:]]
    part = F.struct("src_block", "src_row", "value").alias("_part")
    many = marked.where("_many").select("src_file", *place, part)
    parts = F.array_sort(F.collect_list("_part"))
    joined = many.groupBy(*POSITION).agg(F.array_join(parts["value"], "\n").alias("value"))
    whole = plain.select("value", *POSITION)
    for more in (alone, single, joined):
        whole = whole.unionByName(more.select("value", *POSITION))
    return _told(whole)


def _told(records: DataFrame) -> DataFrame:
    """Records that are not blank, without the return at their end."""
    return records.select(_line(F.col("value")).alias("value"), *POSITION).where(F.trim("value") != "")


def _values(record: Column) -> Column:
    """Values of a record as they stand between the commas, quoted ones with their quotes."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_VALUE), F.lit(1))
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(F.split(record, ",", -1))


def _bare(value: Column) -> Column:
    inner = F.replace(F.substring(value, F.lit(2), F.char_length(value) - 2), F.lit('""'), F.lit('"'))
    return F.when(value.startswith('"') & value.endswith('"') & (F.char_length(value) > 1), inner).otherwise(value)


def _first_lines(lines: DataFrame) -> DataFrame:
    """First line of each file that is not blank: its position, text and number of values (null if one stays open)."""
    rows = lines.where(F.trim(_line(F.col("value"))) != "")
    first = rows.groupBy(*SPLIT).agg(F.min("src_row").alias("src_row")).groupBy("src_file")
    first = first.agg(F.min_by("src_row", "src_block").alias("src_row"), F.min("src_block").alias("src_block"))
    text = _line(F.col("value"))
    found = lookup(lines, stage(first.select(*POSITION), "csv-first"), POSITION, "left_semi")
    return found.select(
        "src_file",
        F.col("src_block").alias("head_block"),
        F.col("src_row").alias("head_row"),
        F.when(~_is_odd(text), text).alias("head_text"),
        F.when(~_is_odd(text), F.size(_values(text))).alias("head_values"),
    )


def read_delimited(lines: DataFrame, needed: list[str], source: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of staged lines.

    Records hold ``heading`` (lower-case names), ``fields`` (values, missing ones null) and the position; ``column``
    reads one by name. A file is rejected if its first record lacks a needed column or names one twice, a record if its
    values are not as many as the heading's names or its quotes do not match. A quote that is never closed costs its own
    line only. Blank lines are left out.
    """
    heads = stage(_first_lines(lines), "csv-heads")
    records = _records(lines, heads.drop("head_text"))
    broken = heads.where("head_text IS NULL")
    if not broken.isEmpty():  # headings with line breaks
        at = broken.select("src_file", F.col("head_block").alias("src_block"), F.col("head_row").alias("src_row"))
        text = lookup(records, at, POSITION, "left_semi").select("src_file", F.col("value").alias("joined"))
        heads = lookup(heads, stage(text, "csv-joined"), ["src_file"], "left")
        heads = heads.withColumn("head_text", F.coalesce("head_text", "joined")).drop("joined")
    text = F.regexp_replace("head_text", "^\ufeff", "")
    heads = heads.withColumn("heading", F.transform(_values(text), lambda v: F.lower(F.trim(_bare(v)))))
    lacking = F.size(F.array_except(F.array(*[F.lit(n) for n in needed]), F.col("heading"))) > 0
    repeated = F.size(F.array_distinct("heading")) < F.size("heading")
    why = F.when(lacking, "no heading with the needed columns").when(repeated, "a column is named twice")
    heads = stage(heads.select("src_file", "head_block", "head_row", "heading", why.alias("_file_reason")), "csv-headings")

    rows = lookup(records, heads, ["src_file"], "left")
    is_heading = (F.col("src_block") == F.col("head_block")) & (F.col("src_row") == F.col("head_row"))
    rows = rows.where(F.col("_file_reason").isNotNull() | ~is_heading).withColumn("_values", _values(F.col("value")))
    matched = F.char_length(F.array_join("_values", ",")) == F.char_length("value")
    reason = F.coalesce(
        "_file_reason",
        F.when(~matched | (_quotes(F.col("value")) % 2 == 1), "quotes do not match"),
        F.when(F.size("_values") < F.size("heading"), "too few values"),
        F.when(F.size("_values") > F.size("heading"), "too many values"),
    )
    missing = F.array(*[F.lit(m) for m in MISSING])
    bare = F.transform(F.transform("_values", _bare), lambda v: F.when(~F.array_contains(missing, v), v))
    rows = rows.withColumn("_reason", reason).select(
        *POSITION,
        "heading",
        "_reason",
        F.when(F.col("_reason").isNull(), bare).alias("fields"),
        F.when(F.col("_reason").isNotNull(), F.col("value")).alias("record"),
    )
    rows = stage(rows, "csv-rows")
    good = rows.where("_reason IS NULL").select("heading", "fields", *POSITION)
    rejects = rows.where("_reason IS NOT NULL").select(
        F.lit(source).alias("source"), "src_file", "record", F.col("_reason").alias("reason")
    )
    return good, rejects


def column(name: str) -> Column:
    """Value of a record in the column of this name; null where the file has none."""
    return F.get("fields", F.array_position("heading", F.lit(name)).cast("int") - 1)
