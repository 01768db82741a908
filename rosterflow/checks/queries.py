"""One query per operator over the whole test tables. Dates are returned as ISO text."""

from __future__ import annotations

import time
import uuid
from datetime import timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.checks import roles
from rosterflow.checks.roles import null_if, table
from rosterflow.functions import dates as D
from rosterflow.functions import paths as P
from rosterflow.functions import report as R
from rosterflow.functions import text as X
from rosterflow.operators import audit as A
from rosterflow.operators import joins as J
from rosterflow.operators import numbering as N
from rosterflow.operators.linking import apply_links, link_forward
from rosterflow.operators.merge import collapse_first, fill_previous_date
from rosterflow.operators.reshape import (
    TRAITS,
    explode_dim,
    explode_map,
    pivot_traits,
    union_by_name,
    unpivot_weeks,
)
from rosterflow.plans import academy as academy_plan
from rosterflow.plans import applicants as applicant_plan
from rosterflow.plans import assessments as assessment_plan
from rosterflow.plans import linked as linked_plan
from rosterflow.plans import star as star_plan
from rosterflow.plans import talent as talent_plan
from rosterflow.plans.appending import ROSTER
from rosterflow.session import checkpoint_root, stage, together
from rosterflow.sinks.tables import (
    append_candidates,
    export_csv,
    export_json,
    export_tables,
    read_ledger,
    read_star,
    write_star,
)
from rosterflow.sources.academy import scan_academy
from rosterflow.sources.applicants import clean_applicants, scan_applicants
from rosterflow.sources.reports import read_assessment_reports
from rosterflow.sources.talent import read_talent_json, shred_talent
from rosterflow.streaming.incremental import run_applicant_updates
from rosterflow.streaming.landing import land, landed
from rosterflow.sources.files import POSITION, list_files, read_csv, read_json

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__.strip("_")] = f
    return f


def _iso(column: str):
    return D.iso_date(F.col(column)).alias(column)


def _long(column: str):
    return F.col(column).cast("long").alias(column)


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


# scalars


@query
def phone_clean(spark, sf):
    raw = F.expr("concat('+44 (', c_nationkey, ') 555 ', c_custkey)")
    return table(spark, sf, "customer").select("c_custkey", X.clean_phone(raw).alias("phone_number"))


def _dated_orders(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_orderdate AS DATE) AS d")


@query
def date_parse_dmy(spark, sf):
    rows = _dated_orders(spark, sf).withColumn(
        "text", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 'unknown' ELSE date_format(d, 'dd/MM/yyyy') END")
    )
    return rows.select("o_orderkey", D.iso_date(D.parse_dmy(F.col("text"))).alias("parsed"))


@query
def date_repair(spark, sf):
    rows = _dated_orders(spark, sf).withColumn("text", F.date_format("d", "d//M/yyyy"))
    return rows.select(
        "o_orderkey", D.compact_date(D.strict_dmy(D.repair_slashes(F.col("text")))).alias("parsed")
    )


@query
def date_day_month(spark, sf):
    rows = (
        _dated_orders(spark, sf)
        .withColumn("day", F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat(dayofmonth(d), '.0') END"))
        .withColumn(
            "month",
            F.expr(
                """CASE WHEN o_orderkey % 7 = 0 THEN NULL
                        WHEN o_orderkey % 3 = 0 THEN date_format(d, 'MMMM yyyy')
                        ELSE concat(upper(substring(date_format(d, 'MMMM'), 1, 4)), ' ', year(d)) END"""
            ),
        )
    )
    return rows.select(
        "o_orderkey",
        D.iso_date(D.invite_date(F.col("day"), F.col("month"))).alias("invited"),
        F.expr("day IS NULL AND month IS NOT NULL").cast("int").alias("day_missing"),
    )


@query
def date_free_text(spark, sf):
    text = F.expr(
        """CASE o_orderkey % 3 WHEN 0 THEN date_format(d, 'EEEE d MMMM yyyy')
                               WHEN 1 THEN date_format(d, 'd MMM yyyy')
                               ELSE date_format(d, 'MMMM d, yyyy') END"""
    )
    return _dated_orders(spark, sf).select("o_orderkey", D.iso_date(D.free_text_date(text)).alias("parsed"))


@query
def person_id(spark, sf):
    rows = roles.people(spark, sf).withColumn("full", F.expr("concat(name, ' O''', seg, '-', pr, '.\\\\')"))
    return rows.select("k", X.person_id(D.compact_date(F.col("d")), F.col("full")).alias("person_id"))


@query
def iddate_ffill(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "user_id", F.expr("CASE WHEN event_id % 7 < 4 THEN NULL ELSE CAST(ts AS DATE) END").alias("day")
    )
    filled = fill_previous_date(events, ["user_id"], "event_id", "day")
    return filled.select("event_id", "iddate", F.col("date_missing").cast("int").alias("date_missing"))


@query
def value_corrections(spark, sf):
    rows = X.correct_values(table(spark, sf, "part"), "p_type", {"ECONOMY": "Economy", "PROMO": "Promotion"})
    return rows.select("p_partkey", "p_type")


@query
def yes_no_map(spark, sf):
    status = F.expr("CASE o_orderstatus WHEN 'F' THEN 'No' WHEN 'O' THEN 'Yes' ELSE o_orderstatus END")
    result = F.expr("CASE o_orderstatus WHEN 'F' THEN 'Fail' WHEN 'O' THEN 'Pass' ELSE o_orderstatus END")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        X.yes_no(status).cast("string").alias("flag"),
        X.pass_fail(result).cast("string").alias("result"),
    )


@query
def safe_casts(spark, sf):
    text = F.expr("CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END")
    rows = table(spark, sf, "lineitem").select("l_linenumber", text.try_cast("int").alias("q"))
    return rows.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("q").alias("n_cast"), F.sum("q").alias("sum_q")
    )


@query
def course_code(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.course_code(F.lower("c_mktsegment")).alias("course_id"))


@query
def behaviour_id(spark, sf):
    name = F.concat("name", F.lit(" "), "seg")
    return roles.people(spark, sf).select("k", X.behaviour_key(name, F.col("d")).alias("behaviour_id"))


@query
def split_week(spark, sf):
    name = F.expr("concat(lower(l_returnflag), '_w', l_linenumber)")
    rows = table(spark, sf, "lineitem").select(X.trait_of(name).alias("trait"), X.week_of(name).alias("week"))
    return rows.groupBy("trait", "week").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def trim_names(spark, sf):
    raw = F.expr("concat('  ', c_name, repeat(' ', c_nationkey))")
    return table(spark, sf, "customer").select(
        "c_custkey", X.trim_spaces(raw).alias("name"), X.upper_name(raw).alias("upper_name")
    )


@query
def report_parse(spark, sf):
    line = F.col("value")
    return roles.report_lines(spark, sf).select(
        F.col("src_row").alias("k"),
        R.has_dash(line).cast("int").alias("has_dash"),
        R.first_name(R.drop_returns(line)).alias("first_name"),
        R.last_name(line).alias("last_name"),
        R.psychometrics(line).cast("string").alias("psychometrics"),
        R.presentation(line).cast("string").alias("presentation"),
        R.first_word(F.col("value")).alias("first_word"),
    )


@query
def path_attributes(spark, sf):
    """Keys, courses and dates taken from paths built from the page addresses."""
    rows = table(spark, sf, "pages").select(
        "page_id",
        F.concat(F.lit("file:/raw/Talent/"), F.col("page_id"), F.lit(".json")).alias("json_path"),
        F.concat(
            F.lit("file:/raw/Academy/"),
            F.element_at(F.split("url", "/"), 3),
            F.lit("_a_"),
            F.col("page_id"),
            F.lit("_2019-06-03.csv"),
        ).alias("csv_path"),
    )
    return rows.select(
        "page_id",
        P.json_key(F.col("json_path")).alias("json_key"),
        P.academy_course(F.col("csv_path")).alias("course_name"),
        D.iso_date(P.academy_date(F.col("csv_path"))).alias("course_date"),
    )


# ids


def _parts(spark, sf):
    return table(spark, sf, "part").select("p_partkey", null_if("p_partkey % 7 = 0", "p_name").alias("p_name"))


def _with_ids(spark, sf, start, nulls):
    parts = _parts(spark, sf)
    dim = N.dense_ids(parts, "p_name", ["p_partkey"], "name_id", start=start, nulls=nulls)
    return parts, dim


@query
def dense_id_one(spark, sf):
    parts, dim = _with_ids(spark, sf, 1, "own")
    return J.attach_ids(parts, dim, "p_name").select("p_partkey", "name_id")


@query
def dense_id_zero(spark, sf):
    _, dim = _with_ids(spark, sf, 0, "drop")
    return dim.select("name_id", "p_name")


@query
def factorize_null(spark, sf):
    parts, dim = _with_ids(spark, sf, 1, "zero")
    return J.attach_ids(parts, dim, "p_name").select("p_partkey", "name_id")


@query
def row_id_locations(spark, sf):
    places = roles.people(spark, sf).select("place", "seg", "pr", "k")
    return N.row_ids(places, ["place", "seg", "pr"], ["k"], "location_id")


def _keyed_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", null_if("o_orderkey % 5 = 0", "o_custkey").alias("json_key")
    )


@query
def synthetic_keys(spark, sf):
    return N.synthetic_keys(_keyed_orders(spark, sf), "json_key", ["o_orderkey"], skip=2)


@query
def skip_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return N.skip_rows(orders, ["o_totalprice", "o_orderkey"], 2).select("o_orderkey")


@query
def first_by_sort(spark, sf):
    """Top 20 by a nullable column, nulls last."""
    rows = _keyed_orders(spark, sf)
    return N.sort_nulls_last(rows, ["json_key", "o_orderkey"]).limit(20)


# nested data and shape


@query
def explode_array_junction(spark, sf):
    """Words of all documents as list values: dimension, and its junction summed per value."""
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    dim, junction = explode_dim(docs, "doc_id", "doc_id", "words", "strength", "strength_id")
    per_value = junction.groupBy("strength_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("doc_id").alias("n_docs"),
        F.sum("doc_id").alias("sum_doc"),
    )
    return dim.join(per_value, "strength_id")


@query
def explode_map_junction(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.map_concat(
            F.from_json("props", "map<string, int>"),
            F.create_map("event_type", F.expr("CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 10 AS INT) END")),
        ).alias("scores"),
    )
    dim, junction = explode_dim(events, "event_id", "event_id", "scores", "tech_name", "tech_id", "score")
    return junction.join(dim, "tech_id").select("event_id", "tech_id", "tech_name", "score")


@query
def unpivot_measures(spark, sf):
    lines = X.lower_columns(
        table(spark, sf, "lineitem").select(
            "l_returnflag",
            F.col("l_quantity").alias("Analytic_W1"),
            null_if("l_linenumber = 2", "l_quantity").alias("Studious_W2"),
            F.col("l_linenumber").alias("Imaginative_W2"),
        )
    )
    long = unpivot_weeks(lines, ["l_returnflag"])
    return long.groupBy("l_returnflag", "trait", "week").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("total")
    )


@query
def pivot_traits_(spark, sf):
    names = ("click", "error", "purchase", "signup", "view")
    events = table(spark, sf, "events").select(
        null_if("user_id % 10 = 0", "user_id").alias("user_id"), F.to_date("ts").alias("day"), "event_type", "value"
    )
    cells = pivot_traits(events, ["user_id", "day"], "event_type", "value", names)
    return cells.select("user_id", _iso("day"), *[F.round(n, 4).alias(n) for n in names])


@query
def union_missing_columns(spark, sf):
    lines = table(spark, sf, "lineitem")
    both = union_by_name(
        [
            lines.select("l_returnflag", "l_quantity", "l_tax"),
            lines.select(F.col("l_discount"), F.col("l_returnflag"), F.col("l_quantity")),
        ]
    )
    return both.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("l_tax").alias("n_tax"), F.count("l_discount").alias("n_discount")
    )


# merge, joins and links


def _interviews(spark, sf):
    return stage(roles.interviews(spark, sf), "interviews")


def _talent_sides(spark, sf):
    return together(spark, lambda: _interviews(spark, sf), lambda: roles.reports(spark, sf))


@query
def collapse_first_non_null(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        null_if("user_id % 10 = 0", "user_id").alias("user_id"),
        null_if("event_id % 3 <> 0", "event_type").alias("event_type"),
        null_if("event_id % 5 <> 0", "value").alias("value"),
        null_if("event_id % 2 = 0", "props").alias("props"),
    )
    return collapse_first(events, "user_id", ["event_id"])


@query
def outer_link(spark, sf):
    """Interviews and assessments by person id; ids missing on a side stay apart."""
    left = _interviews(spark, sf).select("person_id", "json_key")
    right = roles.reports(spark, sf).select(F.col("assessment_id").alias("person_id"), F.col("src_row").alias("report_key"))
    return J.outer_link(left, right, "person_id")


@query
def name_join(spark, sf):
    results, _ = assessment_plan.interview_results(*_talent_sides(spark, sf))
    return results.select(
        "json_key",
        "name",
        _iso("date"),
        "self_development",
        "financial_support_self",
        "result",
        "course_interest",
        "geo_flex",
        "psychometrics",
        "presentation",
        "assessment_id",
        "academyid",
    )


@query
def tech_by_name(spark, sf):
    scores, languages = assessment_plan.tech_by_assessment(*_talent_sides(spark, sf))
    return scores.join(languages, "language_id").groupBy("applicationid", "language_id", "language").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("score").alias("sum_score")
    )


@query
def junction_semi(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("json_key"), "l_quantity")
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("json_key"))
    kept = J.keep_members(lines, orders, "json_key")
    return kept.groupBy("json_key").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query
def fk_orphans(spark, sf):
    orders = table(spark, sf, "orders").select(null_if("o_orderkey % 5 = 0", "o_orderkey").alias("o_orderkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    return J.orphans(orders, "o_orderkey", lines, "l_orderkey")


def _event_side(spark, sf, kind, position, null_rule):
    return table(spark, sf, "events").where(F.col("event_type") == kind).select(
        F.col("user_id"),
        F.expr(f"CASE WHEN {null_rule} THEN NULL ELSE CAST(ts AS DATE) END").alias("day"),
        F.col("event_id").alias(position),
        F.expr("CAST(get_json_object(props, '$.k') AS INT) % 4").alias("bucket"),
    )


@query
def asof_applicant_talent(spark, sf):
    left = _event_side(spark, sf, "signup", "signup_id", "event_id % 7 = 0")
    right = _event_side(spark, sf, "purchase", "purchase_id", "event_id % 5 = 0")
    links = link_forward(
        left.withColumn("linked_id", F.col("signup_id")),
        right,
        ["user_id"],
        "day",
        "signup_id",
        "purchase_id",
        "linked_id",
        "right_wild",
    )
    return apply_links(right, links, "purchase_id", "linked_id", "linked_id").select("purchase_id", "linked_id")


def _course_links(spark, sf, rule):
    left = _event_side(spark, sf, "click", "click_id", "event_id % 7 = 0")
    right = _event_side(spark, sf, "view", "view_id", "event_id % 5 = 0")
    links = link_forward(
        left.withColumn("linked_id", F.col("click_id")),
        right,
        ["user_id", "bucket"],
        "day",
        "click_id",
        "view_id",
        "linked_id",
        rule,
    )
    return links.select("view_id", "linked_id")


@query
def asof_talent_course(spark, sf):
    return _course_links(spark, sf, "left_wild")


@query
def asof_no_null(spark, sf):
    return _course_links(spark, sf, "exclude")


@query
def surrogate_join_back(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("o_"), F.col("o_orderkey")).alias("behaviour_id"), "o_orderkey", "o_orderstatus"
    )
    parents = N.number_rows(
        orders.where("o_orderstatus <> 'P'"), [F.col("o_orderkey")], "trainee_id", 1
    )
    lines = table(spark, sf, "lineitem").select(F.concat(F.lit("o_"), F.col("l_orderkey")).alias("behaviour_id"), "l_quantity")
    joined = J.surrogate_join(lines, parents, "behaviour_id", "trainee_id")
    return joined.groupBy("trainee_id").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query
def dimension_decode(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return J.decode(customer, nation, "c_nationkey").select("c_custkey", "n_name")


# audits


def _holed_events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        null_if("event_id % 3 = 0", "user_id").alias("user_id"),
        null_if("event_id % 7 = 0", "value").alias("value"),
    )


@query
def null_profile(spark, sf):
    profile = A.null_profile(_holed_events(spark, sf))
    return profile.select("column_name", "null_count", F.round("null_percent", 6).alias("null_percent"))


@query
def drop_nulls(spark, sf):
    """Rows without any null, and rows with one column set, in counts."""
    events = _holed_events(spark, sf)
    whole = events.na.drop(how="any").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("kept", F.lit("whole"))
    keyed = events.na.drop(subset=["user_id"]).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("kept", F.lit("keyed"))
    return whole.unionByName(keyed)


@query
def duplicate_values(spark, sf):
    return A.duplicate_values(table(spark, sf, "part"), "p_name")


@query
def duplicate_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    rows = A.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query
def key_audit(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return A.union_audits(
        [
            A.key_audit(orders, "orders", "o_orderkey"),
            A.key_audit(lines, "lineitem", "l_orderkey"),
            A.unique_audit(table(spark, sf, "part"), "part", "p_name"),
        ]
    )


@query
def not_null_audit(spark, sf):
    return A.not_null_audit(_holed_events(spark, sf), "events", ["event_id", "user_id", "value"])


@query
def length_audit(spark, sf):
    documents = A.length_audit(table(spark, sf, "documents"), "documents", {"text": 50, "source": 3})
    return documents.unionByName(A.length_audit(table(spark, sf, "pages"), "pages", {"url": 30}))


@query
def code_collisions(spark, sf):
    parts = table(spark, sf, "part").select("p_name", X.course_code(F.col("p_name")).alias("course_id"))
    return A.code_collisions(parts, "course_id", "p_name")


# files


@query
def csv_round_trip(spark, sf):
    folder = _scratch(spark, "csv")
    export_csv(table(spark, sf, "customer"), folder)
    return read_csv(
        spark, folder, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )


@query
def json_round_trip(spark, sf):
    folder = _scratch(spark, "json")
    events = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string, int>").alias("scores"))
    export_json(events, folder)
    back = read_json(spark, folder, "event_id long, scores map<string, int>")
    return explode_map(back, ["event_id"], "scores", "name", "score").drop("_at")


@query
def applicant_files(spark, sf):
    """Orders written as raw applicant CSV files, scanned and cleaned again."""
    root = _scratch(spark, "raw")
    raw = roles.people(spark, sf).select(
        F.col("k").cast("int").alias("id"),
        F.col("name"),
        F.lit("Female").alias("gender"),
        F.date_format(F.date_sub("d", 9000), "dd/MM/yyyy").alias("dob"),
        F.lit(None).cast("string").alias("email"),
        F.col("place").alias("city"),
        F.col("seg").alias("address"),
        F.col("nk").cast("string").alias("postcode"),
        F.expr("concat('+44 (', nk, ') 555 ', k)").alias("phone_number"),
        F.col("pr").alias("uni"),
        F.lit("1st").alias("degree"),
        F.expr("concat(dayofmonth(d), '.0')").alias("invited_date"),
        F.date_format("d", "MMMM yyyy").alias("month"),
        F.col("pr").alias("invited_by"),
    )
    export_csv(raw, f"{root}/Talent")
    cleaned = clean_applicants(scan_applicants(spark, root)[0])
    return cleaned.select(
        _long("id"), "applicant_id", "name", _iso("dob"), "phone_number", _iso("invited_date"), "invited_by"
    )


@query
def academy_files(spark, sf):
    """Marks written as CSV files with two different headings, scanned and united by name."""
    root = _scratch(spark, "raw")
    marks = stage(roles.academy(spark, sf).drop(*POSITION, "course_name", "date", "behaviour_id"), "marks")
    first = X.prefixed_columns(marks, tuple(f"{t}_w1" for t in TRAITS))
    export_csv(marks.select("name", "trainer", *first), f"{root}/Academy/one")
    export_csv(marks.select(*reversed(marks.columns)), f"{root}/Academy/two")
    scanned, _ = scan_academy(spark, root)
    return scanned.groupBy("name", "trainer").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.sum(c).cast("long").alias(c) for c in X.prefixed_columns(marks, ("analytic_", "imaginative_"))],
    )


@query
def file_listing(spark, sf):
    """Files of an export by folder: each nation's customers stand in a folder of their own."""
    folder = _scratch(spark, "listed")
    table(spark, sf, "customer").select("c_custkey", "c_nationkey").write.partitionBy("c_nationkey").csv(folder)
    paths = list_files(spark, folder, ".csv").where("length > 0")
    return paths.select(
        F.regexp_extract("path", r"c_nationkey=(\d+)/", 1).cast("int").alias("c_nationkey")
    ).distinct()


@query
def incremental_since(spark, sf):
    """Recruiters and places of later invitations, with ids counting on from the stored ones."""
    rows = stage(
        roles.people(spark, sf).select(
            F.col("k").alias("id"),
            "name",
            F.col("pr").alias("city"),
            F.col("place").alias("address"),
            F.col("seg").alias("postcode"),
            F.col("name").alias("applicant_id"),
            F.expr("concat('Rec ', date_format(d, 'yyyy-MM'))").alias("invited_by"),
            "d",
        ),
        "incremental",
    )
    cutoff = F.lit("1998-01-01").cast("date")
    stored = applicant_plan.applicant_tables(rows.where(F.col("d") <= cutoff), ["id"])
    current = {name: stage(stored[name], name) for name in ("recruiters", "location")}
    new = applicant_plan.continue_applicants(rows.where(F.col("d") > cutoff), current, ["id"])
    names = current["recruiters"].unionByName(new["recruiters"])
    recruited = new["applicants"].join(names, "recruiter_id").groupBy("recruiter_name", "recruiter_id").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    place = F.concat_ws("|", *applicant_plan.PLACE).alias("recruiter_name")
    places = new["location"].select(place, F.col("location_id").alias("recruiter_id"), F.lit(1).cast("long").alias("n_rows"))
    return recruited.unionByName(places)


# composed tables


@query
def applicant_tables(spark, sf):
    rows = stage(roles.applicants(spark, sf), "applicants")
    linked, recruiters = applicant_plan.recruit(rows)
    return linked.join(recruiters, "recruiter_id").select(
        "id", "applicant_id", "name", _iso("invited_date"), "recruiter_id", "recruiter_name"
    )


@query
def applicant_locations(spark, sf):
    return applicant_plan.locations(roles.applicants(spark, sf))


@query
def assessment_table(spark, sf):
    rows = assessment_plan.assessment_table(roles.reports(spark, sf))
    return rows.withColumn("date", D.iso_date(F.col("date")))


def _flags_as_text(df: DataFrame) -> DataFrame:
    for c in ("self_development", "financial_support_self", "geo_flex"):
        df = df.withColumn(c, F.col(c).cast("string"))
    return df.withColumn("date", D.iso_date(F.col("date")))


@query
def talent_table(spark, sf):
    talent, academies = talent_plan.talent_tables(*_talent_sides(spark, sf))
    named = talent.join(academies, "academy_location_id", "left")
    return _flags_as_text(named).drop(*talent_plan.ORDER)


@query
def talent_merged(spark, sf):
    talent, _ = talent_plan.merged_talent(*_talent_sides(spark, sf))
    return _flags_as_text(talent)


@query
def strength_tables(spark, sf):
    dim, junction = talent_plan.strength_tables(_interviews(spark, sf), "strengths", "strength", "strength_id")
    return junction.join(dim, "strength_id").groupBy("json_key", "strength_id", "strength").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def tech_tables(spark, sf):
    dim, junction = talent_plan.tech_tables(_interviews(spark, sf))
    return junction.join(dim, "tech_id").select("json_key", "tech_id", "tech_name", "score")


@query
def academy_tables(spark, sf):
    tables = academy_plan.academy_tables(roles.academy(spark, sf))
    rows = (
        tables["trainees"]
        .join(tables["trainers"], "trainer_id")
        .join(tables["courses"], ["course_id", "course_name"])
    )
    return rows.select("trainee_id", "behaviour_id", "name", "trainer_id", "trainer", "course_id", "course_name", _iso("date"))


@query
def behaviour_table(spark, sf):
    rows = academy_plan.behaviours(roles.academy(spark, sf))
    return rows.select("behaviour_id", "name", "week", *TRAITS)


def _linked(spark, sf):
    records, people, invited = together(
        spark,
        lambda: stage(talent_plan.merged_talent(*_talent_sides(spark, sf))[0], "merged"),
        lambda: stage(academy_plan.trainees(roles.academy(spark, sf))[0], "trainees"),
        lambda: stage(roles.applicants(spark, sf), "applicants"),
    )
    return linked_plan.linked_records(records, invited, people, applicant_plan.ORDER)


@query
def linked_talent(spark, sf):
    talent, _ = _linked(spark, sf)
    return _flags_as_text(talent)


@query
def linked_trainees(spark, sf):
    _, people = _linked(spark, sf)
    return people.select("trainee_id", "name", "course_name", "json_key")


def _sources(spark, sf):
    """Applicants, interviews, reports and academy rows."""
    return together(
        spark,
        lambda: stage(roles.applicants(spark, sf), "applicants"),
        lambda: _interviews(spark, sf),
        lambda: roles.reports(spark, sf),
        lambda: stage(roles.academy(spark, sf), "academy"),
    )


def _star(spark, sf):
    sources = _sources(spark, sf)
    tables = star_plan.assemble_star(*sources, applicant_plan.ORDER, POSITION)
    target = _scratch(spark, "star")
    write_star(tables, target)
    return read_star(spark, target)


@query
def star_load(spark, sf):
    """All fifteen tables built, written, read back and counted."""
    return star_plan.table_counts(_star(spark, sf))


@query
def star_audit(spark, sf):
    """Every key, reference, null and length rule on the fifteen tables."""
    return star_plan.audit_star(_star(spark, sf))


@query
def star_contents(spark, sf):
    """Every row of the fifteen tables with every column."""
    rows = []
    for name, df in _star(spark, sf).items():
        values = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns]
        rows.append(df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *values).alias("content")))
    return union_by_name(rows)


def _by_names(tables):
    """Rows of a star with names in place of ids, and of trainees with what tells them apart."""
    academies = tables["academy_locations"].withColumnRenamed("location_name", "academy")
    roster = tables[ROSTER].select("trainee_id", "name", F.col("date").alias("start"))
    trainees = J.bounded_join(tables["trainees"], roster, ["trainee_id"]).join(tables["trainers"], "trainer_id")
    file_key = F.when(F.col("json_key") < N.SYNTHETIC_BASE, F.col("json_key"))
    return {
        **{t: tables[t].select(c) for t, c in (("recruiters", "recruiter_name"), ("academy_locations", "location_name"))},
        **{t: tables[t].select(c) for t, c in (("strengths", "strength"), ("weaknesses", "weakness"))},
        **{t: tables[t].select(c) for t, c in (("tech_self_scores", "tech_name"), ("trainers", "trainer"))},
        "courses": tables["courses"].select("course_id", "course_name"),
        "location": tables["location"].select("applicant_id", "address", "postcode", "city"),
        "applicants": tables["applicants"].join(tables["recruiters"], "recruiter_id").select(
            "applicant_id", "name", "uni", "invited_date", "recruiter_name"
        ),
        "talent": tables["talent"].join(academies, "academy_location_id").withColumn("json_key", file_key).select(
            "applicant_id", "json_key", "date", "self_development", "financial_support_self", "result", "course_interest",
            "psychometric_result", "presentation_result", "geo_flex", "academy",
        ),
        "strengths_junction": tables["strengths_junction"].join(tables["strengths"], "strength_id").select("json_key", "strength"),
        "weaknesses_junction": tables["weaknesses_junction"].join(tables["weaknesses"], "weakness_id").select("json_key", "weakness"),
        "tech_junction": tables["tech_junction"].join(tables["tech_self_scores"], "tech_id").select("json_key", "tech_name", "score"),
        "trainees": trainees.select("name", "start", "course_id", "trainer", "json_key"),
        "behaviours": J.bounded_join(trainees.drop("json_key"), tables["behaviours"], ["trainee_id"]).select(
            "name", "start", "course_id", "week_number", *TRAITS
        ),
    }


@query
def star_append(spark, sf):
    """A star loaded in two parts, each again, gives what one load gives: every row of every table, and the rejects.

    First come all interviews and some files of applicants and trainees, then all reports and the other files.
    """
    applicants, interviews, reports, academy = _sources(spark, sf)
    loads = [
        (applicants.where("src_file < '3'"), interviews, reports.where("false"), academy.where("src_file < 'G'")),
        (applicants.where("src_file >= '3'"), interviews.where("false"), reports, academy.where("src_file >= 'G'")),
    ]
    first, second = (star_plan.assemble_star(*load, applicant_plan.ORDER, POSITION, keep=True) for load in loads)
    target = _scratch(spark, "appended")
    write_star(first, target)
    folder = write_star(second, target, mode="append")
    for again in (second, first):
        write_star(again, target, mode="append")
    tables = _by_names(read_star(spark, target) | read_ledger(spark, target))
    rows = [
        df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns]).alias("content"))
        for name, df in tables.items()
    ]
    rejects = spark.read.parquet(f"{folder}/append_rejects").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    rows.append(rejects.select(F.lit("append_rejects").alias("table_name"), F.concat_ws("|", "source", "n").alias("content")))
    return union_by_name(rows)


def _applicant_root(spark, sf):
    """Applicant files in two column orders, addresses with line breaks, and one of rows that do not fit."""
    root = _scratch(spark, "raw")
    raw = stage(
        roles.people(spark, sf).select(
            F.col("k").cast("int").alias("id"),
            "name",
            F.expr("concat(seg, '\\n', place, ', \"', nk, '\"')").alias("address"),
            F.expr("concat(dayofmonth(d), '.0')").alias("invited_date"),
            F.date_format("d", "MMMM yyyy").alias("month"),
            F.col("pr").alias("invited_by"),
        ),
        "applicant-raw",
    )
    export_csv(raw.where("id % 2 = 0"), f"{root}/Talent/one")
    export_csv(raw.where("id % 2 = 1").select(*reversed(raw.columns)), f"{root}/Talent/two")
    short = F.expr("CASE id % 3 WHEN 0 THEN concat(id, ',short') WHEN 1 THEN concat(id, ',long,F,more') ELSE concat('n', id, ',name,F') END")
    lines = raw.where("id % 10 = 0").select(short.alias("id,name,gender"))
    # one column that holds whole lines: neither separator nor quote occurs in them
    lines.write.option("header", True).option("sep", "\x01").option("quote", "\x02").csv(f"{root}/Talent/odd")
    return root


@query
def applicant_layouts(spark, sf):
    """Columns bound by heading, quoted line breaks kept."""
    rows, _ = scan_applicants(spark, _applicant_root(spark, sf))
    return rows.select("id", "name", "address", "invited_date", "month", "invited_by", "gender")


@query
def applicant_rejects(spark, sf):
    _, rejects = scan_applicants(spark, _applicant_root(spark, sf))
    return rejects.select(F.regexp_extract("record", "[0-9]+", 0).cast("int").alias("id"), "reason")


def _report_texts(spark, sf):
    """Lines of assessment reports, one report per month: heading, blank lines, returns."""
    lines = roles.report_lines(spark, sf).select(
        F.date_format("date", "yyyy-MM").alias("month"),
        F.trunc("date", "month").alias("start"),
        (F.col("src_row") + 10).alias("nth"),
        F.concat("value", F.lit("\r")).alias("value"),
    )
    months = lines.select("month", "start").distinct()
    heads = months.select(
        "month",
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("nth"), F.date_format("start", "EEEE d MMMM yyyy").alias("value")),
                F.struct(F.lit(1).cast("long").alias("nth"), F.concat(F.lit("Town"), F.date_format("start", "MM"), F.lit(" Academy")).alias("value")),
                F.struct(F.lit(2).cast("long").alias("nth"), F.lit("").alias("value")),
                F.struct(F.lit(5).cast("long").alias("nth"), F.lit(" ").alias("value")),
            )
        ).alias("head"),
    ).select("month", "head.nth", "head.value")
    return lines.select("month", "nth", "value").unionByName(heads)


def _write_reports(text, folder):
    """One text file per month."""
    text = text.repartition("month").sortWithinPartitions("month", "nth").select("month", "value")
    text.write.mode("append").partitionBy("month").text(folder)


@query
def report_files(spark, sf):
    """Assessment reports as text files, read, parsed and rejected."""
    root = _scratch(spark, "raw")
    _write_reports(_report_texts(spark, sf), f"{root}/Talent")
    records, rejects = read_assessment_reports(spark, root)
    good = records.select("assessment_id", "psychometrics", "presentation", "academy", F.lit(None).cast("string").alias("reason"))
    bad = rejects.select(F.col("line").alias("assessment_id"), F.col("reject_reason").alias("reason"))
    return good.unionByName(bad, allowMissingColumns=True)


def _two_exports(spark, sf):
    """Applicants written in two steps; gives the folder, and the time after the first step."""
    root = _scratch(spark, "raw")
    raw = stage(roles.people(spark, sf).select(F.col("k").cast("int").alias("id"), "name", F.col("pr").alias("invited_by")), "raw")
    export_csv(raw.where("id % 3 = 0"), f"{root}/Talent/one")
    first = list_files(spark, f"{root}/Talent").agg(F.max("modificationTime")).first()[0]
    time.sleep(0.05)
    return root, raw, first.astimezone(timezone.utc)


@query
def files_since(spark, sf):
    """Only the files written later, even in the same second."""
    root, raw, first = _two_exports(spark, sf)
    export_csv(raw.where("id % 3 > 0"), f"{root}/Talent/two")
    return scan_applicants(spark, root, first)[0].select("id", "name", "invited_by")


@query
def streamed_files(spark, sf):
    """Two runs of the file stream: each file once, ids of recruiters kept."""
    root, raw, _ = _two_exports(spark, sf)
    target = _scratch(spark, "streamed")
    run_applicant_updates(spark, root, target, f"{target}-checkpoint")
    export_csv(raw.where("id % 3 > 0"), f"{root}/Talent/two")
    run_applicant_updates(spark, root, target, f"{target}-checkpoint")
    people, recruiters = (spark.read.parquet(f"{target}/{t}") for t in ("applicants", "recruiters"))
    return people.join(recruiters.drop("batch_id"), "recruiter_id").select("id", "name", "recruiter_name", "batch_id")


def _talent_objects(spark, sf):
    """Suppliers as interview objects."""
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        F.col("s_name").alias("name"),
        F.expr("concat('1//0', s_nationkey % 9 + 1, '/2019')").alias("date"),
        F.expr("map('Java', s_suppkey % 7 + 0.5, 'C', CAST(NULL AS DOUBLE))").alias("tech_self_score"),
        F.expr("array('s', CAST(s_nationkey AS STRING))").alias("strengths"),
        F.expr("CASE s_suppkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END").alias("geo_flex"),
    )


def _write_objects(objects, folder):
    """One file per object; all tasks write, and each moves its own files into the folder."""
    spread = objects.drop("s_suppkey").repartition(4 * objects.sparkSession.sparkContext.defaultParallelism)
    writer = spread.write.mode("append").option("maxRecordsPerFile", 1)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2).json(folder)


@query
def talent_files(spark, sf):
    """Interview objects, one file each, read and cleaned; what hangs on the missing key is rejected."""
    root = _scratch(spark, "raw")
    _write_objects(_talent_objects(spark, sf), f"{root}/Talent")
    records, rejects = read_talent_json(spark, root)
    good = records.select(
        "name", _iso("date"), F.col("tech_self_score")["Java"].alias("java"), "geo_flex", "person_id", F.lit(None).cast("string").alias("reason")
    )
    bad = rejects.select(F.get_json_object("record", "$.strengths[1]").alias("name"), "reason")
    return good.unionByName(bad, allowMissingColumns=True)


@query
def shredded_talent(spark, sf):
    """Interviews cut into core flags, language scores, strengths and weaknesses."""
    parts = shred_talent(_interviews(spark, sf))
    flags = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("self_development", "financial_support_self", "geo_flex")]
    core = parts["core"].select(F.lit("core").alias("part"), "json_key", F.concat_ws("|", *flags).alias("value"))
    tech = parts["tech"].select(F.lit("tech").alias("part"), "json_key", F.col("language").alias("value"), "score")
    strong = parts["strengths"].select(F.lit("strength").alias("part"), "json_key", F.col("strength").alias("value"))
    weak = parts["weaknesses"].select(F.lit("weakness").alias("part"), "json_key", F.col("weakness").alias("value"))
    return union_by_name([tech, core, strong, weak])


def _written_twice(spark, folder, suffix, write, first, second):
    """Files written in two steps; gives the time between them."""
    write(first, folder)
    moment = list_files(spark, folder, suffix).agg(F.max("modificationTime")).first()[0]
    time.sleep(0.05)
    write(second, folder)
    return moment.astimezone(timezone.utc)


@query
def talent_since(spark, sf):
    """Only the interview objects written later."""
    root, objects = _scratch(spark, "raw"), _talent_objects(spark, sf)
    parts = (objects.where("s_suppkey % 2 = 0"), objects.where("s_suppkey % 2 = 1"))
    since = _written_twice(spark, f"{root}/Talent", ".json", _write_objects, *parts)
    records, _ = read_talent_json(spark, root, since)
    return records.select("name", _iso("date"), F.col("tech_self_score")["Java"].alias("java"), "geo_flex", "person_id")


@query
def reports_since(spark, sf):
    """Only the reports written later: those of even months."""
    root, text = _scratch(spark, "raw"), stage(_report_texts(spark, sf), "report-texts")
    even = F.substring("month", 6, 2).cast("int") % 2 == 0
    since = _written_twice(spark, f"{root}/Talent", ".txt", _write_reports, text.where(~even), text.where(even))
    records, _ = read_assessment_reports(spark, root, since)
    return records.select("assessment_id", "psychometrics", "presentation", "academy")


def _academy_parts(spark, sf):
    """Marks of the first week, and of both weeks with the columns the other way round."""
    marks = stage(roles.academy(spark, sf).drop(*POSITION, "course_name", "date", "behaviour_id"), "marks")
    first = X.prefixed_columns(marks, tuple(f"{t}_w1" for t in TRAITS))
    return marks.select("name", "trainer", *first), marks.select(*reversed(marks.columns))


def _export_academy(marks, folder):
    export_csv(marks, f"{folder}/{'both' if 'analytic_w2' in marks.columns else 'one'}")


@query
def academy_since(spark, sf):
    """Only the academy files written later, whose columns stand otherwise."""
    root = _scratch(spark, "raw")
    since = _written_twice(spark, f"{root}/Academy", ".csv", _export_academy, *_academy_parts(spark, sf))
    scanned, _ = scan_academy(spark, root, since)
    return scanned.select("name", "trainer", *[F.col(c).cast("int").alias(c) for c in ("analytic_w1", "analytic_w2", "imaginative_w1", "imaginative_w2")])


def _landed_twice(spark, sf, source, folder, write, first, second):
    """What a stream lands of files that are written in two steps, with the number of the batch."""
    root, landing = _scratch(spark, "raw"), _scratch(spark, "landing")
    for part in (first, second):
        write(part, f"{root}/{folder}")
        land(spark, root, landing, source)
    return landed(spark, landing, source)


@query
def streamed_talent(spark, sf):
    """A stream over interview objects: each once, in two batches."""
    objects = _talent_objects(spark, sf)
    parts = (objects.where("s_suppkey % 2 = 0"), objects.where("s_suppkey % 2 = 1"))
    rows = _landed_twice(spark, sf, "interviews", "Talent", _write_objects, *parts)
    return rows.select("name", _iso("date"), F.col("tech_self_score")["Java"].alias("java"), "geo_flex", "person_id", F.col("batch").cast("int").alias("batch"))


@query
def streamed_reports(spark, sf):
    """A stream over report files: each once, those of even months in the second batch."""
    text = stage(_report_texts(spark, sf), "report-texts")
    even = F.substring("month", 6, 2).cast("int") % 2 == 0
    rows = _landed_twice(spark, sf, "reports", "Talent", _write_reports, text.where(~even), text.where(even))
    return rows.select("assessment_id", "psychometrics", "presentation", "academy", F.col("batch").cast("int").alias("batch"))


@query
def streamed_academy(spark, sf):
    """A stream over academy files whose columns differ: each once, in two batches."""
    rows = _landed_twice(spark, sf, "academy", "Academy", _export_academy, *_academy_parts(spark, sf))
    marks = [F.col(c).cast("int").alias(c) for c in ("analytic_w1", "analytic_w2", "imaginative_w1", "imaginative_w2")]
    return rows.select("name", "trainer", *marks, F.col("batch").cast("int").alias("batch"))


@query
def applicant_long_values(spark, sf):
    """Whole documents as quoted values, with line breaks, commas and quotes, of any length."""
    root = _scratch(spark, "raw")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("name"), F.col("text").alias("address"), F.col("lang").alias("city"))
    export_csv(docs, f"{root}/Talent/documents")
    rows, rejects = scan_applicants(spark, root)
    found = rows.select("id", "name", F.sha2("address", 256).alias("address"), "city")
    return found.unionByName(rejects.select(F.lit(None).cast("int").alias("id"), F.col("reason").alias("name"), F.col("record").alias("address"), F.lit(None).cast("string").alias("city")))


@query
def applicant_stray_quotes(spark, sf):
    """Records with line breaks, and lines whose quote is never closed, which cost themselves only."""
    root = _scratch(spark, "raw")
    many = F.array(
        F.expr("concat(k, ',\"', name, '\",\"', place)"), F.lit("-"), F.expr("concat(seg, ', \"\"', nk, '\"\"\"')")
    )
    lines = F.when(F.col("k") % 7 == 0, F.array(F.expr("concat(k, ',\"', name)"))).otherwise(many)
    rows = roles.people(spark, sf).select(F.explode(lines).alias("id,name,address"))
    rows.write.option("header", True).option("sep", "\x01").option("quote", "\x02").option("emptyValue", "").csv(f"{root}/Talent/stray")
    good, rejects = scan_applicants(spark, root)
    bad = rejects.select(F.regexp_extract("record", "^[0-9]+", 0).cast("int").alias("id"), "reason")
    return good.select("id", "name", "address").unionByName(bad, allowMissingColumns=True)


@query
def exported_strengths(spark, sf):
    """Dimension and junction exported as CSV folders and read back."""
    folder = _scratch(spark, "exported")
    dim, junction = talent_plan.strength_tables(_interviews(spark, sf), "strengths", "strength", "strength_id")
    export_tables({"strengths": dim, "strengths_junction": junction}, folder, ["strengths", "strengths_junction"])
    names = read_csv(spark, f"{folder}/strengths", ", ".join(f"{c} {t}" for c, t in dim.dtypes))
    pairs = read_csv(spark, f"{folder}/strengths_junction", ", ".join(f"{c} {t}" for c, t in junction.dtypes))
    return pairs.join(names, "strength_id").select("json_key", "strength_id", "strength")


@query
def candidate_append(spark, sf):
    """The applicant-only load, in two parts: raw ids and dates dropped, the cleaned ones under their names."""
    target = _scratch(spark, "candidates")
    rows = roles.people(spark, sf).select(
        F.col("k").alias("id"), F.concat("name", F.lit("-"), "k").alias("uniqueid"), F.date_format("d", "yyyyMMdd").alias("iddate"),
        F.dayofmonth("d").alias("invited_date"), F.date_format("d", "yyyy-MM-dd").alias("Invited on"), "name",
    )
    for part in ("id % 2 = 0", "id % 2 = 1"):
        append_candidates(rows.where(part), target)
    return spark.read.parquet(target).select("id", "invited_date", "name")


@query
def nothing_since(spark, sf):
    """Files, none of which is new: empty tables of the same columns, no message."""
    root, raw, _ = _two_exports(spark, sf)
    tables = applicant_plan.applicants_since(spark, root, "2100-01-01T00:00:00")
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), F.lit(",".join(sorted(df.columns))).alias("columns"), "n_rows") for n, df in tables.items()]
    return union_by_name(counts)
