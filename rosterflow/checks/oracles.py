"""Plain SQL for each query, written from the rules rather than from the Spark plans."""

from __future__ import annotations

from rosterflow.plans import star

_PUNCT = "' !\"#$%&''()*+,-./:;<=>?@[]^_`{|}~'"


def _strip(x: str) -> str:
    return f"translate(lower({x}), {_PUNCT}, '')"


def _first(column: str, position: str) -> str:
    return f"arg_min({column}, {position}) FILTER (WHERE {column} IS NOT NULL) AS {column}"


_TALENT = [
    "json_key",
    "name",
    "date",
    "self_development",
    "financial_support_self",
    "result",
    "course_interest",
    "psychometric_result",
    "presentation_result",
    "geo_flex",
    "academy_location_id",
]
_TRAITS = ["analytic", "determined", "imaginative", "independent", "professional", "studious"]


def _flag(c: str) -> str:
    return f"CASE {c} WHEN 'Yes' THEN TRUE WHEN 'No' THEN FALSE END"


# name -> (body, names it needs); the roles of checks.roles and what is derived from them
_CTE: dict[str, tuple[str, list[str]]] = {
    "base": (
        """SELECT o_orderkey AS k, o_orderstatus AS st, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS pr,
                  replace(c_name, '#', ' #') AS name, c_mktsegment AS seg, n_name AS place, c_nationkey AS nk
           FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
        [],
    ),
    "app0": (
        """SELECT pr || '.csv' AS src_file, k AS id, name, pr AS city, place AS address,
                  CAST(nk AS VARCHAR) AS postcode, CASE WHEN k % 7 = 0 THEN NULL ELSE d END AS invited_date,
                  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 5 = 0 THEN 'Fifi Eton' ELSE 'Rec ' || seg END AS invited_by
           FROM base WHERE st = 'F'""",
        ["base"],
    ),
    "app1": (
        """SELECT *, row_number() OVER (ORDER BY src_file, id) AS apos,
                  last_value(invited_date IGNORE NULLS) OVER (PARTITION BY src_file ORDER BY id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM app0""",
        ["app0"],
    ),
    "app": (
        f"""SELECT *, {_strip('name')} || coalesce(strftime(invited_date, '%Y%m%d'),
                   strftime(prev, '%Y%m') || '00', '00000000') AS applicant_id FROM app1""",
        ["app1"],
    ),
    "recruiter": (
        """SELECT invited_by, row_number() OVER (ORDER BY min(apos)) AS recruiter_id FROM app GROUP BY invited_by""",
        ["app"],
    ),
    "place": (
        """SELECT row_number() OVER (ORDER BY min(apos)) - 1 AS location_id, address, postcode, city, applicant_id
           FROM app GROUP BY address, postcode, city, applicant_id""",
        ["app"],
    ),
    "intv0": (
        """SELECT k AS json_key, CAST(k AS VARCHAR) AS key_text,
                  CASE WHEN k % 4 = 0 THEN upper(name) ELSE name END AS name,
                  CASE WHEN k % 17 = 0 THEN NULL ELSE d END AS date,
                  CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS self_development,
                  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'No' ELSE 'Yes' END AS financial_support_self,
                  CASE k % 4 WHEN 0 THEN 'Pass' WHEN 1 THEN 'Fail' END AS result,
                  CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS geo_flex, seg AS course_interest, seg, pr, place
           FROM base WHERE st = 'O'""",
        ["base"],
    ),
    "intv": (
        f"SELECT *, {_strip('name')} || strftime(date, '%Y%m%d') AS person_id FROM intv0",
        ["intv0"],
    ),
    "line": (
        """SELECT k, d AS date, place AS academy, pr || '.txt' AS rf,
                  upper(name) || CASE WHEN k % 3 = 0 THEN '-X,' ELSE '' END
                  || CASE WHEN k % 23 = 0 THEN '' ELSE ' - ' END || ' Psychometrics: '
                  || CASE WHEN k % 29 = 0 THEN 'none' ELSE (k % 101) || '/100' END
                  || ', Presentation: ' || (k % 33) || '/32' AS value
           FROM base WHERE st IN ('O', 'P')""",
        ["base"],
    ),
    "parsed0": (
        """SELECT *, contains(value, '-') AS has_dash,
                  replace(regexp_extract(value, '^(.*)-([^-]*)$', 1), ',', '') AS names,
                  string_split(regexp_extract(value, '^(.*)-([^-]*)$', 2), ',') AS fields FROM line""",
        ["line"],
    ),
    "parsed": (
        """SELECT *, split_part(names, ' ', 1) AS first_name,
                  CASE WHEN contains(names, ' ') THEN trim(substring(names, instr(names, ' ') + 1)) ELSE '' END AS last_name,
                  TRY_CAST(nullif(regexp_extract(fields[len(fields) - 1], '([0-9]{1,3})/', 1), '') AS INTEGER) AS psychometrics,
                  TRY_CAST(nullif(regexp_extract(fields[len(fields)], '([0-9]{1,3})/', 1), '') AS INTEGER) AS presentation
           FROM parsed0""",
        ["parsed0"],
    ),
    "rep": (
        f"""SELECT *, {_strip('first_name || last_name')} || strftime(date, '%Y%m%d') AS assessment_id FROM parsed
            WHERE has_dash AND psychometrics IS NOT NULL AND presentation IS NOT NULL AND date IS NOT NULL""",
        ["parsed"],
    ),
    "pairs0": (
        """SELECT coalesce(i.person_id, r.assessment_id) AS person_id, i.json_key, i.key_text, i.name,
                  i.self_development, i.financial_support_self, i.result, i.course_interest, i.geo_flex,
                  r.psychometrics, r.presentation, r.date, r.academy, r.rf, r.k AS rk
           FROM intv i FULL JOIN rep r ON i.person_id = r.assessment_id""",
        ["intv", "rep"],
    ),
    "pairs": (
        """SELECT *, row_number() OVER (ORDER BY key_text NULLS LAST, rf NULLS FIRST, rk NULLS FIRST) AS rn FROM pairs0""",
        ["pairs0"],
    ),
    "acad": (
        """SELECT academy, row_number() OVER (ORDER BY min(rn)) AS academy_location_id
           FROM pairs WHERE academy IS NOT NULL GROUP BY academy
           UNION ALL SELECT DISTINCT NULL, 0 FROM pairs WHERE academy IS NULL""",
        ["pairs"],
    ),
    "talent": (
        f"""SELECT rn, person_id AS applicant_id, json_key, name, date,
                   {_flag('self_development')} AS self_development,
                   {_flag('financial_support_self')} AS financial_support_self,
                   CASE result WHEN 'Pass' THEN 1 WHEN 'Fail' THEN 0 END AS result, course_interest,
                   psychometrics AS psychometric_result, presentation AS presentation_result,
                   {_flag('geo_flex')} AS geo_flex, academy_location_id, p.academy AS location_name
            FROM pairs p JOIN acad a ON p.academy IS NOT DISTINCT FROM a.academy""",
        ["pairs", "acad"],
    ),
    "merged": (
        f"""SELECT applicant_id, {', '.join(_first(c, 'rn') for c in _TALENT)}
            FROM talent WHERE applicant_id IS NOT NULL GROUP BY applicant_id""",
        ["talent"],
    ),
    "choice": (
        """SELECT m.applicant_id AS tid, a.applicant_id AS new_id, a.apos,
                  row_number() OVER (PARTITION BY a.apos ORDER BY m.date NULLS LAST, m.applicant_id) AS r
           FROM app a JOIN merged m ON lower(m.name) = lower(a.name)
             AND (m.date IS NULL OR m.date >= a.invited_date)
           WHERE a.invited_date IS NOT NULL""",
        ["app", "merged"],
    ),
    "moved": (
        """SELECT m.*, coalesce(c.new_id, m.applicant_id) AS final_id FROM merged m LEFT JOIN
           (SELECT tid, arg_max(new_id, apos) AS new_id FROM choice WHERE r = 1 GROUP BY tid) c ON c.tid = m.applicant_id""",
        ["merged", "choice"],
    ),
    "final": (
        f"""SELECT final_id AS applicant_id, {', '.join(_first(c, 'moved.applicant_id') for c in _TALENT)}
            FROM moved GROUP BY final_id""",
        ["moved"],
    ),
    "academy0": (
        """SELECT k, name, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 5 = 0 THEN 'Elly Kelly' ELSE 'Trainer ' || pr END AS trainer,
                  seg AS course_name, CASE WHEN k % 19 = 0 THEN NULL ELSE d END AS date,
                  row_number() OVER (ORDER BY seg, k) AS trainee_id
           FROM base WHERE st = 'P'""",
        ["base"],
    ),
    "academy": (
        """SELECT *, replace(name || strftime(date, '%Y-%m-%d'), ' ', '_') AS behaviour_id,
                  upper(substring(course_name, 1, 3)) AS course_id FROM academy0""",
        ["academy0"],
    ),
    "trainer": (
        """SELECT trainer, CAST(row_number() OVER (ORDER BY min(trainee_id)) AS VARCHAR) AS trainer_id
           FROM academy GROUP BY trainer""",
        ["academy"],
    ),
    "mark": (
        """SELECT a.*, t.i, w.week,
                  CASE WHEN w.week = 2 AND (k % 4 = 0 OR (k % 6 = 0 AND t.i = 2)) THEN NULL ELSE (k + t.i + w.week) % 9 END AS value
           FROM academy a, (VALUES (0), (1), (2), (3), (4), (5)) t(i), (VALUES (1), (2)) w(week)""",
        ["academy"],
    ),
    "behaviour": (
        f"""SELECT behaviour_id, name, week,
                   {', '.join(f"CAST(trunc(avg(value) FILTER (WHERE i = {i})) AS INTEGER) AS {t}" for i, t in enumerate(_TRAITS))}
            FROM mark WHERE value IS NOT NULL AND behaviour_id IS NOT NULL AND trainer IS NOT NULL AND date IS NOT NULL
            GROUP BY behaviour_id, name, trainer, course_name, date, week""",
        ["mark"],
    ),
    "course_choice": (
        """SELECT t.trainee_id, m.json_key, m.applicant_id,
                  row_number() OVER (PARTITION BY m.applicant_id ORDER BY t.date NULLS LAST, t.trainee_id) AS r
           FROM moved m JOIN academy t ON t.name = m.name AND t.course_name = m.course_interest
             AND (m.date IS NULL OR t.date >= m.date)""",
        ["moved", "academy"],
    ),
    "followed": (
        """SELECT a.*, c.json_key FROM academy a LEFT JOIN
           (SELECT trainee_id, arg_max(json_key, applicant_id) AS json_key FROM course_choice WHERE r = 1
            GROUP BY trainee_id) c ON c.trainee_id = a.trainee_id""",
        ["academy", "course_choice"],
    ),
    "strength_long": (
        """SELECT json_key, key_text, nth, value FROM (
             SELECT json_key, key_text, 0 AS nth, pr AS value FROM intv UNION ALL
             SELECT json_key, key_text, 1, seg FROM intv UNION ALL
             SELECT json_key, key_text, 3, pr FROM intv)""",
        ["intv"],
    ),
    "strength": (
        """SELECT value, row_number() OVER (ORDER BY min(rn)) - 1 AS strength_id FROM
           (SELECT value, row_number() OVER (ORDER BY key_text, nth) AS rn FROM strength_long) GROUP BY value""",
        ["strength_long"],
    ),
    "weakness_long": (
        """SELECT json_key, key_text, 0 AS nth, place AS value FROM intv WHERE json_key % 6 <> 0 UNION ALL
           SELECT json_key, key_text, 1, seg FROM intv WHERE json_key % 6 <> 0""",
        ["intv"],
    ),
    "tech_long": (
        """SELECT json_key, key_text, nth, tech_name, score FROM (
             SELECT json_key, key_text, 0 AS nth, seg AS tech_name, CAST(json_key % 10 AS INTEGER) AS score FROM intv UNION ALL
             SELECT json_key, key_text, 1, pr, CASE WHEN json_key % 9 = 0 THEN NULL ELSE CAST(json_key % 7 AS INTEGER) END
             FROM intv) WHERE score IS NOT NULL""",
        ["intv"],
    ),
    "tech": (
        """SELECT tech_name, row_number() OVER (ORDER BY min(rn)) - 1 AS tech_id FROM
           (SELECT tech_name, row_number() OVER (ORDER BY key_text, nth) AS rn FROM tech_long) GROUP BY tech_name""",
        ["tech_long"],
    ),
    "named": (
        """SELECT i.json_key, i.key_text, upper(i.name) AS name, i.date, i.self_development, i.financial_support_self,
                  i.result, i.course_interest, i.geo_flex, i.seg, i.pr, r.psychometrics, r.presentation, r.assessment_id,
                  r.academy, row_number() OVER (ORDER BY i.key_text, r.rf, r.k) AS rn,
                  r.rf, r.k AS rk
           FROM intv i JOIN rep r ON upper(i.name) = r.first_name || ' ' || r.last_name""",
        ["intv", "rep"],
    ),
    "named_tech": (
        """SELECT *, row_number() OVER (ORDER BY assessment_id, key_text, rf, rk, nth) AS pos FROM
           (SELECT n.*, t.nth, t.tech_name AS language, t.score FROM named n JOIN tech_long t ON t.json_key = n.json_key)""",
        ["named", "tech_long"],
    ),
}


def _with(names: list[str], select: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _CTE[name][1]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTE[n][0]})" for n in ordered) + "\n" + select


def _iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


_FLAGS = """CAST(self_development AS VARCHAR) AS self_development,
            CAST(financial_support_self AS VARCHAR) AS financial_support_self, CAST(geo_flex AS VARCHAR) AS geo_flex"""
_RECORD = f"""applicant_id, json_key, name, {_iso('date')} AS date, {_FLAGS}, result, course_interest,
              psychometric_result, presentation_result, academy_location_id"""

_DENSE = """WITH v AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS p_name FROM part),
            d AS (SELECT p_name, row_number() OVER (ORDER BY min(p_partkey)) AS name_id FROM v {where} GROUP BY p_name)
            {select}"""


def _side(kind: str, position: str, null_rule: str) -> str:
    return f"""SELECT user_id, CASE WHEN {null_rule} THEN NULL ELSE CAST(ts AS DATE) END AS day, event_id AS {position},
               CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS bucket FROM events WHERE event_type = '{kind}'"""


def _course(match: str) -> str:
    return f"""WITH l AS ({_side('click', 'click_id', 'event_id % 7 = 0')}),
        r AS ({_side('view', 'view_id', 'event_id % 5 = 0')}),
        c AS (SELECT click_id, view_id, row_number() OVER (PARTITION BY click_id ORDER BY r.day NULLS LAST, view_id) AS n
              FROM l JOIN r ON l.user_id = r.user_id AND l.bucket = r.bucket AND {match})
        SELECT view_id, max(click_id) AS linked_id FROM c WHERE n = 1 GROUP BY view_id"""


_HOLED = """WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id,
            CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events) """
_DAY = "CAST(o_orderdate AS DATE)"


def _star() -> str:
    counts = {
        "recruiters": "recruiter",
        "applicants": "app",
        "academy_locations": "acad",
        "talent": "final",
        "strengths": "strength",
        "weaknesses": "(SELECT DISTINCT value FROM weakness_long)",
        "tech_self_scores": "tech",
        "strengths_junction": "strength_long WHERE json_key IN (SELECT json_key FROM final)",
        "weaknesses_junction": "weakness_long WHERE json_key IN (SELECT json_key FROM final)",
        "tech_junction": "tech_long WHERE json_key IN (SELECT json_key FROM final)",
        "location": "place",
        "courses": "(SELECT DISTINCT course_id, course_name FROM academy)",
        "trainers": "trainer",
        "trainees": "followed",
        "behaviours": "behaviour b JOIN followed f ON f.behaviour_id = b.behaviour_id",
    }
    select = "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}" for name, source in counts.items()
    )
    needed = ["recruiter", "acad", "final", "strength", "weakness_long", "tech", "place", "trainer", "followed", "behaviour"]
    return _with(needed, select)


# the fifteen tables with the columns the rules look at
_TABLES = {
    "recruiters": "SELECT recruiter_id, invited_by AS recruiter_name FROM recruiter",
    "applicants": """SELECT applicant_id, recruiter_id FROM app JOIN recruiter
        ON app.invited_by IS NOT DISTINCT FROM recruiter.invited_by""",
    "academy_locations": "SELECT academy_location_id FROM acad",
    "talent": """SELECT row_number() OVER (ORDER BY json_key IS NULL, applicant_id) AS talent_id, applicant_id,
        academy_location_id, coalesce(json_key, 999999999 + row_number() OVER
        (PARTITION BY json_key IS NULL ORDER BY applicant_id)) AS json_key FROM final""",
    "strengths": "SELECT strength_id, value AS strength FROM strength",
    "weaknesses": "SELECT row_number() OVER () AS weakness_id, value AS weakness FROM (SELECT DISTINCT value FROM weakness_long)",
    "tech_self_scores": "SELECT tech_id, tech_name FROM tech",
    "strengths_junction": """SELECT json_key, strength_id FROM strength_long JOIN strength USING (value)
        WHERE json_key IN (SELECT json_key FROM final)""",
    "weaknesses_junction": "SELECT json_key FROM weakness_long WHERE json_key IN (SELECT json_key FROM final)",
    "tech_junction": """SELECT json_key, tech_id, score FROM tech_long JOIN tech USING (tech_name)
        WHERE json_key IN (SELECT json_key FROM final)""",
    "location": "SELECT location_id, applicant_id FROM place",
    "courses": "SELECT DISTINCT course_id, course_name FROM academy",
    "trainers": "SELECT trainer_id, trainer FROM trainer",
    "trainees": """SELECT trainee_id, json_key, trainer_id, course_id FROM followed JOIN trainer
        ON followed.trainer IS NOT DISTINCT FROM trainer.trainer""",
    "behaviours": """SELECT row_number() OVER () AS behaviour_id, f.trainee_id, b.week AS week_number
        FROM behaviour b JOIN followed f ON f.behaviour_id = b.behaviour_id""",
}


def _audit() -> str:
    rows = []

    def rule(table: str, name: str, column: str, count: str) -> None:
        rows.append(f"SELECT '{table}' AS table_name, '{name}' AS rule, '{column}' AS column_name, ({count}) AS violations")

    def repeated(table: str, column: str) -> str:
        return f"SELECT count(*) FROM (SELECT 1 FROM t_{table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"

    for table, column in star.PRIMARY_KEYS.items():
        rule(table, "pk_not_null", column, f"SELECT count(*) FROM t_{table} WHERE {column} IS NULL")
        rule(table, "pk_unique", column, repeated(table, column))
    for table, column in star.UNIQUE:
        rule(table, "unique", column, repeated(table, column))
    for child, fk, parent, pk in star.FOREIGN_KEYS:
        exists = f"EXISTS (SELECT 1 FROM t_{parent} p WHERE p.{pk} = c.{fk})"
        rule(child, "fk", fk, f"SELECT count(*) FROM t_{child} c WHERE {fk} IS NOT NULL AND NOT {exists}")
    for table, columns in star.NOT_NULL.items():
        for column in columns:
            rule(table, "not_null", column, f"SELECT count(*) FROM t_{table} WHERE {column} IS NULL")
    for table, limits in star.LENGTHS.items():
        for column, limit in limits.items():
            rule(table, "length", column, f"SELECT count(*) FROM t_{table} WHERE length({column}) > {limit}")
    needed = ["recruiter", "acad", "final", "strength", "weakness_long", "tech", "place", "trainer", "followed", "behaviour"]
    tables = ",\n".join(f"t_{name} AS ({body})" for name, body in _TABLES.items())
    return _with(needed, "").rstrip() + ",\n" + tables + "\n" + "\nUNION ALL ".join(rows)


def _contents() -> str:
    nulls = {c: "NULL" for c in ("gender", "dob", "email", "phone_number", "degree")}
    tables = _TABLES | {
        "applicants": f"""SELECT applicant_id, name, city AS uni_source, (SELECT seg FROM base WHERE k = app.id) AS uni,
            {', '.join(f'{v} AS {c}' for c, v in nulls.items())}, invited_date, recruiter_id FROM app JOIN recruiter
            ON app.invited_by IS NOT DISTINCT FROM recruiter.invited_by""",
        "academy_locations": "SELECT academy_location_id, academy AS location_name FROM acad",
        "talent": """SELECT row_number() OVER (ORDER BY json_key IS NULL, applicant_id) AS talent_id,
            * REPLACE (coalesce(json_key, 999999999 + row_number() OVER
            (PARTITION BY json_key IS NULL ORDER BY applicant_id)) AS json_key) FROM final""",
        "weaknesses": """SELECT row_number() OVER (ORDER BY min(rn)) - 1 AS weakness_id, value AS weakness FROM
            (SELECT value, row_number() OVER (ORDER BY key_text, nth) AS rn FROM weakness_long) GROUP BY value""",
        "weaknesses_junction": """SELECT json_key, weakness_id FROM weakness_long JOIN t_weaknesses ON value = weakness
            WHERE json_key IN (SELECT json_key FROM final)""",
        "location": "SELECT location_id, applicant_id, address, postcode, city FROM place",
        "trainees": """SELECT trainee_id, json_key, trainer_id, course_id, NULL AS date FROM followed JOIN trainer
            ON followed.trainer IS NOT DISTINCT FROM trainer.trainer""",
        "behaviours": f"""SELECT row_number() OVER (ORDER BY f.trainee_id, b.week, {', '.join(_TRAITS)}) AS behaviour_id,
            f.trainee_id, b.week AS week_number, {', '.join(_TRAITS)}
            FROM behaviour b JOIN followed f ON f.behaviour_id = b.behaviour_id""",
    }
    needed = ["recruiter", "acad", "final", "strength", "weakness_long", "tech", "place", "trainer", "followed", "behaviour"]
    bodies = ",\n".join(f"t_{name} AS ({body})" for name, body in tables.items())
    rows = [
        f"""SELECT '{name}' AS table_name, concat_ws('|', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)})
            AS content FROM t_{name}"""
        for name, columns in star.COLUMNS.items()
    ]
    return _with(needed, "").rstrip() + ",\n" + bodies + "\n" + "\nUNION ALL ".join(rows)


_MONTHLY = f"""SELECT {_strip('first_name || last_name')} || strftime(date_trunc('month', date), '%Y%m%d') AS assessment_id,
    psychometrics, presentation, 'Town' || strftime(date, '%m') AS academy{{more}} FROM parsed
    WHERE has_dash AND psychometrics IS NOT NULL AND presentation IS NOT NULL"""
_WEEKS = ", ".join(
    f"CAST(max(value) FILTER (WHERE i = {i} AND week = {w}) AS INTEGER) AS {t}_w{w}" for i, t in ((0, "analytic"), (2, "imaginative")) for w in (1, 2)
)


def _by_names() -> str:
    """The star of one load with names in place of ids; applicants of the second load only where their id is new."""
    marks = ", ".join(_TRAITS)
    people = """SELECT applicant_id, name, (SELECT seg FROM base WHERE k = app.id) AS uni, invited_date, invited_by AS recruiter_name,
                src_file < '3' AS early FROM app"""
    tables = {
        "recruiters": ("SELECT invited_by FROM recruiter", ["invited_by"]),
        "academy_locations": ("SELECT academy FROM acad UNION SELECT NULL", ["academy"]),
        "strengths": ("SELECT value FROM strength", ["value"]),
        "weaknesses": ("SELECT DISTINCT value FROM weakness_long", ["value"]),
        "tech_self_scores": ("SELECT tech_name FROM tech", ["tech_name"]),
        "trainers": ("SELECT trainer FROM trainer", ["trainer"]),
        "courses": ("SELECT DISTINCT course_id, course_name FROM academy", ["course_id", "course_name"]),
        "location": ("SELECT * FROM place", ["applicant_id", "address", "postcode", "city"]),
        "applicants": (
            "SELECT * FROM people p WHERE early OR NOT EXISTS (SELECT 1 FROM people q WHERE q.early AND q.applicant_id = p.applicant_id)",
            ["applicant_id", "name", "uni", "invited_date", "recruiter_name"],
        ),
        "talent": (
            "SELECT f.*, academy FROM final f JOIN acad USING (academy_location_id)",
            ["applicant_id", "json_key", "date", "self_development", "financial_support_self", "result", "course_interest",
             "psychometric_result", "presentation_result", "geo_flex", "academy"],
        ),
        "strengths_junction": ("SELECT * FROM strength_long WHERE json_key IN (SELECT json_key FROM final)", ["json_key", "value"]),
        "weaknesses_junction": ("SELECT * FROM weakness_long WHERE json_key IN (SELECT json_key FROM final)", ["json_key", "value"]),
        "tech_junction": (
            "SELECT * FROM tech_long WHERE json_key IN (SELECT json_key FROM final)", ["json_key", "tech_name", "score"],
        ),
        "trainees": ("SELECT * FROM followed", ["name", "date", "course_id", "trainer", "json_key"]),
        "behaviours": (
            f"SELECT f.name, f.date, f.course_id, b.week, {marks} FROM behaviour b JOIN followed f ON f.behaviour_id = b.behaviour_id",
            ["name", "date", "course_id", "week", *_TRAITS],
        ),
        "append_rejects": (
            """SELECT 'applicants' AS source, count(*) AS n FROM people p WHERE NOT early
               AND EXISTS (SELECT 1 FROM people q WHERE q.early AND q.applicant_id = p.applicant_id)
               AND NOT EXISTS (SELECT 1 FROM people q WHERE q.early AND q.applicant_id = p.applicant_id
                 AND q.name IS NOT DISTINCT FROM p.name AND q.uni IS NOT DISTINCT FROM p.uni
                 AND q.invited_date IS NOT DISTINCT FROM p.invited_date AND q.recruiter_name IS NOT DISTINCT FROM p.recruiter_name)
               HAVING count(*) > 0""",
            ["source", "n"],
        ),
    }
    needed = ["recruiter", "acad", "final", "strength", "weakness_long", "tech", "place", "trainer", "followed", "behaviour"]
    rows = [
        f"""SELECT '{name}' AS table_name, concat_ws('|', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)})
            AS content FROM ({body})"""
        for name, (body, columns) in tables.items()
    ]
    return _with(needed, "").rstrip() + f",\npeople AS ({people})\n" + "\nUNION ALL ".join(rows)


ORACLES: dict[str, str] = {
    "phone_clean": """SELECT c_custkey, replace(replace(replace('+44 (' || c_nationkey || ') 555 ' || c_custkey,
        '(', ''), ')', ''), ' ', '-') AS phone_number FROM customer""",
    "date_parse_dmy": f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_iso(_DAY)} END AS parsed FROM orders""",
    "date_repair": f"SELECT o_orderkey, strftime({_DAY}, '%Y%m%d') AS parsed FROM orders",
    "date_day_month": f"""SELECT o_orderkey,
        CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE {_iso(_DAY)} END AS invited,
        CAST(o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0 AS INTEGER) AS day_missing FROM orders""",
    "date_free_text": f"SELECT o_orderkey, {_iso(_DAY)} AS parsed FROM orders",
    "person_id": _with(
        ["base"],
        f"""SELECT k, {_strip("name || ' O''' || seg || '-' || pr || '.' || chr(92)")} || strftime(d, '%Y%m%d') AS person_id
            FROM base""",
    ),
    "iddate_ffill": """WITH e AS (SELECT event_id, user_id,
          CASE WHEN event_id % 7 < 4 THEN NULL ELSE CAST(ts AS DATE) END AS day FROM events),
        f AS (SELECT *, last_value(day IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM e)
        SELECT event_id, coalesce(strftime(day, '%Y%m%d'), strftime(prev, '%Y%m') || '00', '00000000') AS iddate,
          CAST(day IS NULL AND prev IS NULL AS INTEGER) AS date_missing FROM f""",
    "value_corrections": """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'PROMO' THEN 'Promotion'
        ELSE p_type END AS p_type FROM part""",
    "yes_no_map": """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'true' WHEN 'F' THEN 'false' END AS flag,
        CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'F' THEN '0' END AS result FROM orders""",
    "safe_casts": """SELECT l_linenumber, count(*) AS n_rows,
        count(*) FILTER (WHERE l_linenumber <> 3) AS n_cast,
        CAST(sum(CAST(l_quantity AS INTEGER)) FILTER (WHERE l_linenumber <> 3) AS BIGINT) AS sum_q
        FROM lineitem GROUP BY l_linenumber""",
    "course_code": "SELECT c_custkey, upper(left(c_mktsegment, 3)) AS course_id FROM customer",
    "behaviour_id": _with(
        ["base"], f"SELECT k, replace(name || ' ' || seg || {_iso('d')}, ' ', '_') AS behaviour_id FROM base"
    ),
    "split_week": """SELECT lower(l_returnflag) AS trait, l_linenumber AS week, count(*) AS n_rows
        FROM lineitem GROUP BY ALL""",
    "trim_names": """SELECT c_custkey, c_name AS name, '  ' || upper(c_name) || repeat(' ', c_nationkey) AS upper_name
        FROM customer""",
    "report_parse": _with(
        ["parsed"],
        """SELECT k, CAST(has_dash AS INTEGER) AS has_dash, first_name, last_name,
           CAST(psychometrics AS VARCHAR) AS psychometrics, CAST(presentation AS VARCHAR) AS presentation,
           'CUSTOMER' AS first_word FROM parsed""",
    ),
    "path_attributes": """SELECT page_id, page_id AS json_key, split_part(url, '/', 3) || '_a' AS course_name,
        '2019-06-03' AS course_date FROM pages""",
    "dense_id_one": _DENSE.format(
        where="", select="SELECT p_partkey, name_id FROM v JOIN d ON v.p_name IS NOT DISTINCT FROM d.p_name"
    ),
    "dense_id_zero": _DENSE.format(where="WHERE p_name IS NOT NULL", select="SELECT name_id - 1 AS name_id, p_name FROM d"),
    "factorize_null": _DENSE.format(
        where="WHERE p_name IS NOT NULL",
        select="SELECT p_partkey, coalesce(name_id, 0) AS name_id FROM v LEFT JOIN d ON v.p_name = d.p_name",
    ),
    "row_id_locations": _with(
        ["base"],
        """SELECT place, seg, pr, row_number() OVER (ORDER BY min(k)) - 1 AS location_id FROM base GROUP BY place, seg, pr""",
    ),
    "synthetic_keys": """SELECT o_orderkey, o_custkey AS json_key FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL
        SELECT o_orderkey, json_key FROM (SELECT o_orderkey, 999999999 + row_number() OVER (ORDER BY o_orderkey) AS json_key
        FROM orders WHERE o_orderkey % 5 = 0) WHERE json_key >= 1000000002""",
    "skip_rows": "SELECT o_orderkey FROM orders ORDER BY o_totalprice NULLS LAST, o_orderkey OFFSET 2",
    "first_by_sort": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS json_key
        FROM orders ORDER BY json_key NULLS LAST, o_orderkey LIMIT 20""",
    "explode_array_junction": """WITH s AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
        l AS (SELECT doc_id, generate_subscripts(w, 1) AS nth, unnest(w) AS strength FROM s),
        f AS (SELECT strength, min((doc_id, nth)) AS pos, count(*) AS n_rows, count(DISTINCT doc_id) AS n_docs,
              CAST(sum(doc_id) AS BIGINT) AS sum_doc FROM l GROUP BY strength)
        SELECT row_number() OVER (ORDER BY pos) - 1 AS strength_id, strength, n_rows, n_docs, sum_doc FROM f""",
    "explode_map_junction": """WITH l AS (
          SELECT event_id, 0 AS nth, 'k' AS tech_name, CAST(json_extract_string(props, '$.k') AS INTEGER) AS score FROM events
          UNION ALL SELECT event_id, 1, event_type, CAST(event_id % 10 AS INTEGER) FROM events WHERE event_id % 4 <> 0),
        d AS (SELECT tech_name, row_number() OVER (ORDER BY min((event_id, nth))) - 1 AS tech_id FROM l GROUP BY tech_name)
        SELECT event_id, tech_id, tech_name, score FROM l JOIN d USING (tech_name)""",
    "unpivot_measures": """SELECT l_returnflag, trait, week, count(*) AS n_rows, round(sum(v), 2) AS total FROM (
          SELECT l_returnflag, 'analytic' AS trait, 1 AS week, l_quantity AS v FROM lineitem UNION ALL
          SELECT l_returnflag, 'studious', 2, l_quantity FROM lineitem WHERE l_linenumber <> 2 UNION ALL
          SELECT l_returnflag, 'imaginative', 2, CAST(l_linenumber AS DOUBLE) FROM lineitem) GROUP BY ALL""",
    "pivot_traits": """SELECT user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
          round(avg(value) FILTER (WHERE event_type = 'click'), 4) AS click,
          round(avg(value) FILTER (WHERE event_type = 'error'), 4) AS error,
          round(avg(value) FILTER (WHERE event_type = 'purchase'), 4) AS purchase,
          round(avg(value) FILTER (WHERE event_type = 'signup'), 4) AS signup,
          round(avg(value) FILTER (WHERE event_type = 'view'), 4) AS view
        FROM events WHERE user_id % 10 <> 0 GROUP BY 1, 2""",
    "union_missing_columns": """SELECT l_returnflag, 2 * count(*) AS n_rows, count(l_tax) AS n_tax,
        count(l_discount) AS n_discount FROM lineitem GROUP BY l_returnflag""",
    "collapse_first_non_null": """WITH e AS (SELECT event_id, user_id,
          CASE WHEN event_id % 3 <> 0 THEN NULL ELSE event_type END AS event_type,
          CASE WHEN event_id % 5 <> 0 THEN NULL ELSE value END AS value,
          CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS props FROM events WHERE user_id % 10 <> 0)
        SELECT user_id, arg_min(event_type, event_id) FILTER (WHERE event_type IS NOT NULL) AS event_type,
          arg_min(value, event_id) FILTER (WHERE value IS NOT NULL) AS value,
          arg_min(props, event_id) FILTER (WHERE props IS NOT NULL) AS props FROM e GROUP BY user_id""",
    "outer_link": _with(["pairs0"], "SELECT person_id, json_key, rk AS report_key FROM pairs0"),
    "name_join": _with(
        ["named"],
        f"""SELECT json_key, name, {_iso('date')} AS date, self_development, financial_support_self, result,
            course_interest, geo_flex, psychometrics, presentation, assessment_id, academyid
            FROM named JOIN (SELECT academy, row_number() OVER (ORDER BY min(rn)) - 1 AS academyid FROM named
            GROUP BY academy) USING (academy)""",
    ),
    "tech_by_name": _with(
        ["named_tech"],
        """SELECT assessment_id AS applicationid, language_id, language, count(*) AS n_rows,
           CAST(sum(score) AS BIGINT) AS sum_score FROM named_tech JOIN
           (SELECT language, row_number() OVER (ORDER BY min(pos)) - 1 AS language_id FROM named_tech GROUP BY language)
           USING (language) GROUP BY ALL""",
    ),
    "junction_semi": """SELECT l_orderkey AS json_key, count(*) AS n_rows, round(sum(l_quantity), 2) AS qty FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey""",
    "fk_orphans": """SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0
        AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "asof_applicant_talent": f"""WITH l AS ({_side('signup', 'signup_id', 'event_id % 7 = 0')}),
        r AS ({_side('purchase', 'purchase_id', 'event_id % 5 = 0')}),
        c AS (SELECT signup_id, purchase_id,
                row_number() OVER (PARTITION BY signup_id ORDER BY r.day NULLS LAST, purchase_id) AS n
              FROM l JOIN r ON l.user_id = r.user_id AND (r.day IS NULL OR r.day >= l.day) WHERE l.day IS NOT NULL)
        SELECT r.purchase_id, g.linked_id FROM r LEFT JOIN
          (SELECT purchase_id, max(signup_id) AS linked_id FROM c WHERE n = 1 GROUP BY purchase_id) g
          ON g.purchase_id = r.purchase_id""",
    "asof_talent_course": _course("(l.day IS NULL OR r.day >= l.day)"),
    "asof_no_null": _course("r.day >= l.day"),
    "surrogate_join_back": """WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS trainee_id
          FROM orders WHERE o_orderstatus <> 'P')
        SELECT trainee_id, count(*) AS n_rows, round(sum(l_quantity), 2) AS qty
        FROM lineitem JOIN p ON o_orderkey = l_orderkey GROUP BY trainee_id""",
    "dimension_decode": "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
    "null_profile": _HOLED
    + """SELECT column_name, null_count, round(null_count * 100.0 / n, 6) AS null_percent FROM (
          SELECT 'event_id' AS column_name, count(*) FILTER (WHERE event_id IS NULL) AS null_count, count(*) AS n FROM e UNION ALL
          SELECT 'user_id', count(*) FILTER (WHERE user_id IS NULL), count(*) FROM e UNION ALL
          SELECT 'value', count(*) FILTER (WHERE value IS NULL), count(*) FROM e)""",
    "drop_nulls": _HOLED
    + """SELECT count(*) AS n_rows, 'whole' AS kept FROM e WHERE user_id IS NOT NULL AND value IS NOT NULL UNION ALL
         SELECT count(*), 'keyed' FROM e WHERE user_id IS NOT NULL""",
    "duplicate_values": "SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1",
    "duplicate_rows": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, count(*) OVER
        (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""",
    "key_audit": """SELECT 'orders' AS table_name, 'pk_not_null' AS rule, 'o_orderkey' AS column_name,
          count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders UNION ALL
        SELECT 'orders', 'pk_unique', 'o_orderkey', count(*) FROM
          (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1) UNION ALL
        SELECT 'lineitem', 'pk_not_null', 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem UNION ALL
        SELECT 'lineitem', 'pk_unique', 'l_orderkey', count(*) FROM
          (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1) UNION ALL
        SELECT 'part', 'unique', 'p_name', count(*) FROM (SELECT 1 FROM part GROUP BY p_name HAVING count(*) > 1)""",
    "not_null_audit": _HOLED
    + """SELECT 'events' AS table_name, 'not_null' AS rule, c AS column_name, violations FROM (
          SELECT 'event_id' AS c, count(*) FILTER (WHERE event_id IS NULL) AS violations FROM e UNION ALL
          SELECT 'user_id', count(*) FILTER (WHERE user_id IS NULL) FROM e UNION ALL
          SELECT 'value', count(*) FILTER (WHERE value IS NULL) FROM e)""",
    "length_audit": """SELECT 'documents' AS table_name, 'length' AS rule, 'text' AS column_name,
          count(*) FILTER (WHERE length(text) > 50) AS violations FROM documents UNION ALL
        SELECT 'documents', 'length', 'source', count(*) FILTER (WHERE length(source) > 3) FROM documents UNION ALL
        SELECT 'pages', 'length', 'url', count(*) FILTER (WHERE length(url) > 30) FROM pages""",
    "code_collisions": """SELECT upper(left(p_name, 3)) AS course_id, count(DISTINCT p_name) AS n_values FROM part
        GROUP BY 1 HAVING count(DISTINCT p_name) > 1""",
    "csv_round_trip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "json_round_trip": """SELECT event_id, 'k' AS name, CAST(json_extract_string(props, '$.k') AS INTEGER) AS score FROM events""",
    "applicant_files": _with(
        ["base"],
        f"""SELECT k AS id, {_strip('name')} || strftime(d, '%Y%m%d') AS applicant_id, name,
            {_iso('d - INTERVAL 9000 DAY')} AS dob, '+44-' || nk || '-555-' || k AS phone_number,
            {_iso('d')} AS invited_date, pr AS invited_by FROM base""",
    ),
    "academy_files": _with(
        ["mark"],
        """SELECT name, trainer, count(*) FILTER (WHERE i = 0 AND week = 1) * 2 AS n_rows,
           CAST(sum(2 * value) FILTER (WHERE i = 0 AND week = 1) AS BIGINT) AS analytic_w1,
           CAST(sum(value) FILTER (WHERE i = 0 AND week = 2) AS BIGINT) AS analytic_w2,
           CAST(sum(2 * value) FILTER (WHERE i = 2 AND week = 1) AS BIGINT) AS imaginative_w1,
           CAST(sum(value) FILTER (WHERE i = 2 AND week = 2) AS BIGINT) AS imaginative_w2
           FROM mark GROUP BY name, trainer""",
    ),
    "file_listing": "SELECT DISTINCT c_nationkey FROM customer",
    "incremental_since": _with(
        ["base"],
        """, r AS (SELECT k, d, 'Rec ' || strftime(d, '%Y-%m') AS rec, name, pr, place, seg FROM base),
        o AS (SELECT rec, row_number() OVER (ORDER BY min(k)) AS id FROM r WHERE d <= DATE '1998-01-01' GROUP BY rec),
        n AS (SELECT rec, (SELECT max(id) FROM o) + row_number() OVER (ORDER BY min(k)) AS id FROM r
              WHERE d > DATE '1998-01-01' AND rec NOT IN (SELECT rec FROM o) GROUP BY rec),
        lo AS (SELECT DISTINCT place, seg, pr, name FROM r WHERE d <= DATE '1998-01-01'),
        ln AS (SELECT DISTINCT place, seg, pr, name FROM r WHERE d > DATE '1998-01-01' EXCEPT SELECT * FROM lo)
        SELECT a.rec AS recruiter_name, a.id AS recruiter_id, count(*) AS n_rows
        FROM r JOIN (SELECT * FROM o UNION ALL SELECT * FROM n) a ON a.rec = r.rec
        WHERE d > DATE '1998-01-01' GROUP BY 1, 2
        UNION ALL SELECT concat_ws('|', place, seg, pr, name), (SELECT count(*) FROM lo) - 1 + row_number() OVER (ORDER BY min(k)), 1
        FROM r JOIN ln USING (place, seg, pr, name) WHERE d > DATE '1998-01-01' GROUP BY place, seg, pr, name""".lstrip(),
    ).replace("\n, r AS", ", r AS"),
    "applicant_tables": _with(
        ["recruiter"],
        f"""SELECT id, applicant_id, name, {_iso('invited_date')} AS invited_date, recruiter_id,
            app.invited_by AS recruiter_name
            FROM app JOIN recruiter ON app.invited_by IS NOT DISTINCT FROM recruiter.invited_by""",
    ),
    "applicant_locations": _with(["place"], "SELECT * FROM place"),
    "assessment_table": _with(
        ["rep"],
        f"""SELECT first_name, last_name, psychometrics, presentation, {_iso('date')} AS date, academy, assessment_id FROM rep""",
    ),
    "talent_table": _with(["talent"], f"SELECT {_RECORD}, location_name FROM talent"),
    "talent_merged": _with(["merged"], f"SELECT {_RECORD} FROM merged"),
    "strength_tables": _with(
        ["strength"],
        """SELECT json_key, strength_id, value AS strength, count(*) AS n_rows
           FROM strength_long JOIN strength USING (value) GROUP BY ALL""",
    ),
    "tech_tables": _with(["tech"], "SELECT json_key, tech_id, tech_name, score FROM tech_long JOIN tech USING (tech_name)"),
    "academy_tables": _with(
        ["trainer"],
        f"""SELECT trainee_id, behaviour_id, name, trainer_id, a.trainer, course_id, course_name, {_iso('date')} AS date
            FROM academy a JOIN trainer t ON a.trainer IS NOT DISTINCT FROM t.trainer""",
    ),
    "behaviour_table": _with(["behaviour"], "SELECT * FROM behaviour"),
    "linked_talent": _with(["final"], f"SELECT {_RECORD} FROM final"),
    "linked_trainees": _with(["followed"], "SELECT trainee_id, name, course_name, json_key FROM followed"),
    "star_load": _star(),
    "star_audit": _audit(),
    "star_contents": _contents(),
    "star_append": _by_names(),
    "applicant_layouts": _with(
        ["base"],
        """SELECT CAST(k AS INTEGER) AS id, name, seg || chr(10) || place || ', "' || nk || '"' AS address,
           day(d) || '.0' AS invited_date, strftime(d, '%B %Y') AS month, pr AS invited_by, NULL AS gender FROM base""",
    ),
    "applicant_rejects": _with(
        ["base"],
        """SELECT CAST(k AS INTEGER) AS id, CASE k % 3 WHEN 0 THEN 'too few values' WHEN 1 THEN 'too many values'
           ELSE 'no whole number as id' END AS reason FROM base WHERE k % 10 = 0""",
    ),
    "report_files": _with(
        ["parsed"],
        f"""SELECT {_strip('first_name || last_name')} || strftime(date_trunc('month', date), '%Y%m%d') AS assessment_id,
           psychometrics, presentation, 'Town' || strftime(date, '%m') AS academy, NULL AS reason FROM parsed
           WHERE has_dash AND psychometrics IS NOT NULL AND presentation IS NOT NULL
           UNION ALL SELECT value, NULL, NULL, NULL, CASE WHEN has_dash THEN 'no score' ELSE 'no dash' END FROM parsed
           WHERE NOT has_dash OR psychometrics IS NULL OR presentation IS NULL""",
    ),
    "files_since": _with(
        ["base"], "SELECT CAST(k AS INTEGER) AS id, name, pr AS invited_by FROM base WHERE k % 3 > 0"
    ),
    "streamed_files": _with(
        ["base"],
        "SELECT CAST(k AS INTEGER) AS id, name, pr AS recruiter_name, CAST(k % 3 > 0 AS INTEGER) AS batch_id FROM base",
    ),
    "talent_files": f"""SELECT s_name AS name, '2019-0' || (s_nationkey % 9 + 1) || '-01' AS date, CAST(s_suppkey % 7 AS INTEGER) AS java,
        CASE s_suppkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS geo_flex,
        {_strip('s_name')} || '20190' || (s_nationkey % 9 + 1) || '01' AS person_id, NULL AS reason FROM supplier
        UNION ALL SELECT CAST(s_nationkey AS VARCHAR), NULL, NULL, NULL, NULL, 'no whole number in the file name' FROM supplier""",
    "shredded_talent": _with(
        ["intv", "tech_long", "strength_long", "weakness_long"],
        f"""SELECT 'tech' AS part, json_key, tech_name AS value, score FROM tech_long
        UNION ALL SELECT 'core', json_key, concat_ws('|', {', '.join(f"coalesce(CAST({_flag(c)} AS VARCHAR), '-')" for c in ('self_development', 'financial_support_self', 'geo_flex'))}), NULL FROM intv
        UNION ALL SELECT 'strength', json_key, value, NULL FROM strength_long
        UNION ALL SELECT 'weakness', json_key, value, NULL FROM weakness_long""",
    ),
    "talent_since": f"""SELECT s_name AS name, '2019-0' || (s_nationkey % 9 + 1) || '-01' AS date, CAST(s_suppkey % 7 AS INTEGER) AS java,
        CASE s_suppkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS geo_flex,
        {_strip('s_name')} || '20190' || (s_nationkey % 9 + 1) || '01' AS person_id FROM supplier WHERE s_suppkey % 2 = 1""",
    "streamed_talent": f"""SELECT s_name AS name, '2019-0' || (s_nationkey % 9 + 1) || '-01' AS date, CAST(s_suppkey % 7 AS INTEGER) AS java,
        CASE s_suppkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS geo_flex,
        {_strip('s_name')} || '20190' || (s_nationkey % 9 + 1) || '01' AS person_id, CAST(s_suppkey % 2 AS INTEGER) AS batch FROM supplier""",
    "reports_since": _with(["parsed"], _MONTHLY.replace("{more}", "") + " AND month(date) % 2 = 0"),
    "streamed_reports": _with(["parsed"], _MONTHLY.replace("{more}", ", CAST(month(date) % 2 = 0 AS INTEGER) AS batch")),
    "academy_since": _with(["mark"], f"SELECT name, trainer, {_WEEKS} FROM mark GROUP BY trainee_id, name, trainer"),
    "streamed_academy": _with(
        ["mark"],
        f"""SELECT name, trainer, {_WEEKS}, 1 AS batch FROM mark GROUP BY trainee_id, name, trainer
        UNION ALL SELECT name, trainer, CAST(max(value) FILTER (WHERE i = 0 AND week = 1) AS INTEGER), NULL,
        CAST(max(value) FILTER (WHERE i = 2 AND week = 1) AS INTEGER), NULL, 0 FROM mark GROUP BY trainee_id, name, trainer""",
    ),
    "applicant_long_values": "SELECT CAST(doc_id AS INTEGER) AS id, source AS name, sha256(nullif(text, '')) AS address, lang AS city FROM documents",
    "applicant_stray_quotes": _with(
        ["base"],
        """SELECT CAST(k AS INTEGER) AS id, name, place || chr(10) || '-' || chr(10) || seg || ', "' || nk || '"' AS address, NULL AS reason
           FROM base WHERE k % 7 <> 0 UNION ALL SELECT CAST(k AS INTEGER), NULL, NULL, 'quotes do not match' FROM base WHERE k % 7 = 0""",
    ),
    "exported_strengths": _with(
        ["strength"], "SELECT json_key, strength_id, value AS strength FROM strength_long JOIN strength USING (value)"
    ),
    "candidate_append": _with(
        ["base"], "SELECT name || '-' || k AS id, strftime(d, '%Y-%m-%d') AS invited_date, name FROM base"
    ),
    "nothing_since": """SELECT * FROM (VALUES
        ('applicants', 'applicant_id,date_missing,day_missing,degree,dob,dob_unreadable,email,gender,id,iddate,invited_date,name,phone_number,recruiter_id,src_file,uni', CAST(0 AS BIGINT)),
        ('location', 'address,applicant_id,city,location_id,postcode', 0),
        ('recruiters', 'recruiter_id,recruiter_name', 0),
        ('rejects', 'reason,record,source,src_file', 0)) t(table_name, columns, n_rows)""",
}
