"""DuckDB SQL equal in meaning to each registered query (tables are pre-registered views).

The adapters of ``labormart.plans.adapters`` are repeated here as CTEs. Rules kept on both
sides: floor() before casting doubles to BIGINT (DuckDB rounds, Spark truncates); sums of
BIGINT cast back to BIGINT (DuckDB widens to HUGEINT); ISO text via strftime; ties broken on
the name ascending with nulls last before every LIMIT.
"""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%SZ'"

OV = f"""ov AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id,
         o.o_orderpriority AS name,
         strftime(o.o_orderdate, {ISO}) AS published_at,
         strftime(o.o_orderdate, {ISO}) AS collected_at,
         CASE WHEN o.o_orderkey % 7 = 0 THEN 0
              ELSE CAST(floor(o.o_totalprice) AS BIGINT) END AS salary_from,
         CASE WHEN o.o_orderkey % 11 = 0 THEN 0
              ELSE (CASE WHEN o.o_orderkey % 7 = 0 THEN 0
                         ELSE CAST(floor(o.o_totalprice) AS BIGINT) END)
                   + (o.o_orderkey % 10) * 10000 END AS salary_to,
         CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE n.n_name END AS area_name,
         c.c_name AS employer_name,
         CAST(NULL AS VARCHAR) AS snippet_requirement
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

# Raw records flattened; sf/st are the parsed salary bounds (null when not given),
# has_salary says whether the salary record exists.
RV = f"""rv AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS id,
         CASE WHEN l.l_returnflag = 'R' THEN o.o_orderstatus ELSE o.o_orderpriority END AS name,
         l.l_linenumber <> 6 AS has_salary,
         CASE WHEN l.l_linenumber IN (6, 7) THEN NULL
              WHEN l.l_discount = 0 THEN -CAST(floor(l.l_extendedprice) AS BIGINT)
              ELSE CAST(floor(l.l_extendedprice) AS BIGINT) END AS sf,
         CASE WHEN l.l_linenumber = 6 THEN NULL
              WHEN l.l_returnflag = 'A' THEN CAST(floor(l.l_extendedprice / 2) AS BIGINT)
              WHEN l.l_quantity = 50 THEN CAST(floor(l.l_extendedprice) AS BIGINT) * 200
              ELSE CAST(floor(l.l_extendedprice * (1 + l.l_tax)) AS BIGINT) END AS st,
         CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN '' ELSE CAST(n.n_nationkey AS VARCHAR) END
           AS area_id,
         n.n_name AS area_name,
         c.c_name AS employer_name,
         c.c_mktsegment AS snippet_requirement,
         strftime(o.o_orderdate, {ISO}) AS published_at,
         strftime(l.l_shipdate + to_minutes(l.l_linenumber), {ISO}) AS collected_at,
         l.l_shipdate + to_minutes(l.l_linenumber) AS cts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

# "First" copy of an id: collected_at, then the other columns in schema order, nulls first
# (the library's rule). For the raw records, the name breaks the ties that matter here.
DEDUP = """dd AS (
  SELECT * FROM rv QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY collected_at NULLS FIRST, name NULLS FIRST) = 1)"""

# Cleaning flattens and casts before de-duplicating, so the tie order uses the cast values.
CLEAN = """cl AS (
  SELECT * FROM (
    SELECT id, name, published_at, collected_at,
           COALESCE(sf, 0) AS salary_from, COALESCE(st, 0) AS salary_to,
           area_name, employer_name, snippet_requirement
    FROM rv)
  QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY collected_at NULLS FIRST, name NULLS FIRST,
      published_at NULLS FIRST, salary_from NULLS FIRST, salary_to NULLS FIRST,
      area_name NULLS FIRST, employer_name NULLS FIRST, snippet_requirement NULLS FIRST) = 1
     AND name IS NOT NULL AND length(name) >= 3)"""

TV = """tv AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, lang AS area_name, source AS employer_name,
         text AS snippet_requirement FROM documents
  UNION ALL
  SELECT 'p' || CAST(page_id AS VARCHAR), 'web',
         regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), html FROM pages)"""

EV = """ev AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id, e.ts, e.event_type AS area_name,
         CAST(floor(e.value * 1000) AS BIGINT) AS salary_from,
         CAST(floor(e.value * 1500) AS BIGINT) AS salary_to,
         d.text AS snippet_requirement
  FROM events e LEFT JOIN documents d ON e.user_id = d.doc_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _band5(x: str = "salary_from") -> str:
    return (f"CASE WHEN {x} < 50000 THEN '< 50K' WHEN {x} < 100000 THEN '50K-100K' "
            f"WHEN {x} < 200000 THEN '100K-200K' WHEN {x} < 300000 THEN '200K-300K' "
            f"ELSE '> 300K' END")


def _band4(x: str = "salary_from") -> str:
    return (f"CASE WHEN {x} < 50000 THEN '< 50K' WHEN {x} < 100000 THEN '50K-100K' "
            f"WHEN {x} < 200000 THEN '100K-200K' ELSE '> 200K' END")


def _histogram(bins: int) -> str:
    return _with(OV) + f"""
, pos AS (SELECT salary_from AS x FROM ov WHERE salary_from > 0),
  mm AS (SELECT min(x) AS mn, max(x) AS mx FROM pos),
  b AS (SELECT CASE WHEN (mx - mn) / {float(bins)} > 0
                    THEN CAST(least(floor((x - mn) / ((mx - mn) / {float(bins)})), {bins - 1}) AS INTEGER)
                    ELSE 0 END AS bin, mn, mx FROM pos, mm)
SELECT bin,
       CAST(mn + bin * ((mx - mn) / {float(bins)}) AS DOUBLE) AS bin_start,
       CAST(mn + (bin + 1) * ((mx - mn) / {float(bins)}) AS DOUBLE) AS bin_end,
       count(*) AS count
FROM b GROUP BY bin, mn, mx ORDER BY bin"""


def _box(n: int) -> str:
    return _with(OV) + f"""
, pos AS (SELECT * FROM ov WHERE salary_from > 0),
  top AS (SELECT area_name FROM pos GROUP BY area_name
          ORDER BY count(*) DESC, area_name ASC NULLS LAST LIMIT {n}),
  r AS (SELECT pos.* FROM pos WHERE area_name IN (SELECT area_name FROM top)),
  st AS (SELECT area_name, count(*) AS count, min(salary_from) AS min,
                quantile_cont(salary_from, 0.25) AS q1, quantile_cont(salary_from, 0.5) AS median,
                quantile_cont(salary_from, 0.75) AS q3, max(salary_from) AS max
         FROM r GROUP BY area_name),
  f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM st)
SELECT f.area_name, f.count, f.min, f.q1, f.median, f.q3, f.max, f.lower_fence, f.upper_fence,
       (SELECT count(*) FROM r WHERE r.area_name = f.area_name
          AND (r.salary_from < f.lower_fence OR r.salary_from > f.upper_fence)) AS outliers
FROM f ORDER BY count DESC, area_name"""


def _errors(profile: str) -> str:
    fr = "COALESCE(sf, 0)"
    to = "COALESCE(st, 0)"
    parts = ["CASE WHEN strlen(COALESCE(name, '')) < 3 THEN 'name too short (min 3 chars)' END"]
    if profile == "extended":
        parts.append("CASE WHEN strlen(COALESCE(name, '')) > 500 THEN 'name too long (max 500 chars)' END")
    parts.append(f"CASE WHEN {fr} < 0 THEN 'salary_from cannot be negative' END")
    if profile == "extended":
        parts.append(f"CASE WHEN {to} > 0 AND {fr} > {to} THEN 'salary_from (' || {fr} || ') > salary_to (' || {to} || ')' END")
        parts.append(f"CASE WHEN {to} > 10000000 THEN 'salary_to ' || {to} || ' > 10M RUB (unrealistic)' END")
    else:
        parts.append(f"CASE WHEN {to} > 0 AND {fr} > {to} THEN 'salary_from > salary_to' END")
        parts.append(f"CASE WHEN {to} > 10000000 THEN 'salary_to > 10M RUB (unrealistic)' END")
    parts.append("CASE WHEN COALESCE(area_id, '') = '' THEN 'area_id is required' END")
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


def _validated(profile: str = "base") -> str:
    return _with(RV) + f", va AS (SELECT *, {_errors(profile)} AS errs FROM rv)\n"


_VAL_OUT = """SELECT id, collected_at, len(errs) = 0 AS is_valid, CAST(len(errs) AS INTEGER) AS n_errors,
       CASE WHEN len(errs) > 0 THEN array_to_string(errs, '; ') || '; ' END AS error_text
FROM va"""


def _ascii_lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _literal_skills_counts(keywords: list[str], source: str = "tv", by: str | None = None) -> str:
    low = _ascii_lower("snippet_requirement")
    sel = ", ".join(
        f"count_if(instr({low}, '{k.lower()}') > 0) AS k{i}" for i, k in enumerate(keywords))
    unp = " UNION ALL ".join(
        f"SELECT {by + ', ' if by else ''}'{k}' AS skill, k{i} AS count FROM w"
        for i, k in enumerate(keywords))
    grp = f" GROUP BY {by}" if by else ""
    return f"w AS (SELECT {by + ', ' if by else ''}{sel} FROM {source}{grp}), s AS ({unp})"


def _regex_skill_counts(keywords: list[str]) -> str:
    def test(k: str) -> str:
        if k == "C++":  # the unescaped pattern means "contains c" (possessive c+)
            return "snippet_requirement ILIKE '%c%'"
        return f"regexp_matches(snippet_requirement, '(?i){k}')"
    sel = ", ".join(f"count_if({test(k)}) AS k{i}" for i, k in enumerate(keywords))
    unp = " UNION ALL ".join(f"SELECT '{k}' AS skill, k{i} AS count FROM w"
                             for i, k in enumerate(keywords))
    return f"w AS (SELECT {sel} FROM tv), s AS ({unp})"


def _literal_keywords() -> list[str]:
    from labormart.schema import LITERAL_SKILLS

    return list(LITERAL_SKILLS)


def _regex_keywords() -> list[str]:
    from labormart.schema import REGEX_SKILLS

    return list(REGEX_SKILLS)


def _tumbling_base(size: str) -> str:
    return _with(EV) + f""", t AS (
  SELECT time_bucket(INTERVAL '{size}', ts) AS ws, *,
         NULLIF(salary_from, 0) AS f, NULLIF(salary_to, 0) AS tt,
         (NULLIF(salary_from, 0) IS NOT NULL OR NULLIF(salary_to, 0) IS NOT NULL) AS h
  FROM ev)
"""


_ACC = """COALESCE(avg(CASE WHEN h THEN f END), 0.0) AS avg_from,
       COALESCE(avg(CASE WHEN h THEN tt END), 0.0) AS avg_to,
       CAST(COALESCE(min(NULLIF(CASE WHEN h THEN f END, 0)), 0) AS BIGINT) AS min_from,
       CAST(greatest(COALESCE(max(CASE WHEN h THEN tt END), 0), 0) AS BIGINT) AS max_to,
       count_if(h) AS with_salary"""


def _tumbling_by_area(size: str) -> str:
    return _tumbling_base(size) + f"""
SELECT strftime(ws, {ISO}) AS window_start, strftime(ws + INTERVAL '{size}', {ISO}) AS window_end,
       area_name AS area, count(*) AS area_count, {_ACC}
FROM t GROUP BY ws, area_name"""


def _tumbling_raw_by_area(size: str) -> str:
    """Averages over the bounds that are given, zeros too; the least bound is a non-zero one."""
    return _with(RV) + f""", t AS (
  SELECT time_bucket(INTERVAL '{size}', cts) AS ws, area_name, has_salary,
         CASE WHEN sf < 0 THEN 0 ELSE sf END AS f, st AS tt
  FROM rv)
SELECT strftime(ws, {ISO}) AS window_start, strftime(ws + INTERVAL '{size}', {ISO}) AS window_end,
       area_name AS area, count(*) AS area_count,
       COALESCE(avg(f) FILTER (WHERE has_salary), 0.0) AS avg_from,
       COALESCE(avg(tt) FILTER (WHERE has_salary), 0.0) AS avg_to,
       COALESCE(min(f) FILTER (WHERE has_salary AND f <> 0), 0) AS min_from,
       COALESCE(max(tt) FILTER (WHERE has_salary AND tt > 0), 0) AS max_to,
       count(*) FILTER (WHERE has_salary) AS with_salary
FROM t GROUP BY ws, area_name"""


def _tumbling_total(size: str) -> str:
    return _tumbling_base(size) + f"""
SELECT strftime(ws, {ISO}) AS window_start, strftime(ws + INTERVAL '{size}', {ISO}) AS window_end,
       count(*) AS total_count, {_ACC}
FROM t GROUP BY ws"""


def _tumbling_skills_cte(size: str, n: int) -> str:
    kws = _literal_keywords()
    low = _ascii_lower("snippet_requirement")
    sel = ", ".join(f"count_if(instr({low}, '{k.lower()}') > 0) AS k{i}" for i, k in enumerate(kws))
    unp = " UNION ALL ".join(f"SELECT ws, '{k}' AS skill, k{i} AS count FROM w"
                             for i, k in enumerate(kws))
    return f""", w AS (SELECT ws, {sel} FROM t GROUP BY ws),
  s AS ({unp}),
  r AS (SELECT ws, skill, count,
               row_number() OVER (PARTITION BY ws ORDER BY count DESC, skill ASC) AS rank
        FROM s WHERE count > 0)
"""


def _tumbling_top_skills(size: str, n: int = 10) -> str:
    return _tumbling_base(size) + _tumbling_skills_cte(size, n) + f"""
SELECT strftime(ws, {ISO}) AS window_start, strftime(ws + INTERVAL '{size}', {ISO}) AS window_end,
       CAST(rank AS INTEGER) AS rank, skill, count
FROM r WHERE rank <= {n}"""


def _window_report(size: str) -> str:
    return _tumbling_base(size) + _tumbling_skills_cte(size, 1) + f"""
, pa AS (SELECT ws, area_name AS area, count(*) AS area_count,
                COALESCE(avg(CASE WHEN h THEN f END), 0.0) AS avg_salary_from,
                COALESCE(avg(CASE WHEN h THEN tt END), 0.0) AS avg_salary_to
         FROM t GROUP BY ws, area_name),
  tot AS (SELECT ws, count(*) AS total_count FROM t GROUP BY ws)
SELECT strftime(pa.ws, {ISO}) AS window_start, strftime(pa.ws + INTERVAL '{size}', {ISO}) AS window_end,
       tot.total_count, pa.area, pa.area_count, pa.avg_salary_from, pa.avg_salary_to,
       COALESCE(r.skill, '') AS top_skill, COALESCE(r.count, 0) AS skill_count
FROM pa JOIN tot ON pa.ws = tot.ws LEFT JOIN r ON r.ws = pa.ws AND r.rank = 1"""


def _sliding_by_area(size: str, slide: str, k: int) -> str:
    return _with(EV) + f""", x AS (
  SELECT time_bucket(INTERVAL '{slide}', ts) - i * INTERVAL '{slide}' AS ws, area_name AS area,
         CASE WHEN salary_from > 0 THEN salary_from END AS pos
  FROM ev, range({k}) AS r(i)),
  ba AS (SELECT ws, area, count(*) AS cnt, sum(pos) AS salary_sum, count(pos) AS salary_n
         FROM x GROUP BY ws, area)
"""


def _sliding_stats(size: str, slide: str, k: int, window_sec: int) -> str:
    return _sliding_by_area(size, slide, k) + f"""
SELECT strftime(ws, {ISO}) AS window_start, strftime(ws + INTERVAL '{size}', {ISO}) AS window_end,
       {window_sec} AS window_sec, CAST(sum(cnt) AS BIGINT) AS total,
       COALESCE(CAST(sum(salary_sum) AS DOUBLE) / sum(salary_n), 0.0) AS avg_salary_from,
       arg_min(area, (-cnt, area)) AS top_area, CAST(max(cnt) AS BIGINT) AS top_area_count
FROM ba GROUP BY ws"""


def _sliding_top_area(size: str, slide: str, k: int) -> str:
    return _sliding_by_area(size, slide, k) + f"""
SELECT strftime(ws, {ISO}) AS window_start, strftime(ws + INTERVAL '{size}', {ISO}) AS window_end,
       arg_min(area, (-cnt, area)) AS top_area, CAST(max(cnt) AS BIGINT) AS top_area_count
FROM ba GROUP BY ws"""


def _sliding_top5(size: str, slide: str, k: int, n: int = 5) -> str:
    return _sliding_by_area(size, slide, k) + f"""
SELECT strftime(ws, {ISO}) AS window_start, strftime(ws + INTERVAL '{size}', {ISO}) AS window_end,
       CAST(rank AS INTEGER) AS rank, area, CAST(cnt AS BIGINT) AS cnt
FROM (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY cnt DESC, area ASC) AS rank FROM ba)
WHERE rank <= {n}"""


def _msg_fallback() -> str:
    # nested messages: raw records; flat messages: clean orders; document texts are not JSON.
    return _with(RV, OV) + """, m AS (
  SELECT COALESCE(area_name, 'Unknown') AS area,
         COALESCE(CASE WHEN has_salary THEN sf END, 0) AS salary FROM rv
  UNION ALL
  SELECT COALESCE(NULLIF(area_name, ''), 'Unknown'), COALESCE(NULLIF(salary_from, 0), 0) FROM ov)
SELECT area, count(*) AS count,
       CAST(sum(CASE WHEN salary > 0 THEN salary END) AS BIGINT) AS salary_sum,
       count_if(salary > 0) AS with_salary
FROM m GROUP BY area"""


def _null_profile() -> str:
    cols = [("id", "string"), ("name", "string"), ("published_at", "string"),
            ("collected_at", "string"), ("salary_from", "bigint"), ("salary_to", "bigint"),
            ("area_name", "string"), ("employer_name", "string"),
            ("snippet_requirement", "string")]
    unions = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column, '{t}' AS type, "
        f"count_if({c} IS NULL) AS nulls FROM cl" for i, (c, t) in enumerate(cols))
    return _with(RV, DEDUP, CLEAN) + unions


def _stage_counts() -> str:
    return _with(RV, DEDUP, CLEAN) + f""", va AS (SELECT *, {_errors('base')} AS errs FROM rv),
  s AS (SELECT CAST(0 AS INTEGER) AS step, 'load' AS stage, count(*) AS rows_out FROM rv
        UNION ALL SELECT 1, 'dedup', count(*) FROM dd
        UNION ALL SELECT 2, 'clean', count(*) FROM cl
        UNION ALL SELECT 3, 'valid', count(*) FROM va WHERE len(errs) = 0)
SELECT step, stage, rows_out, lag(rows_out) OVER (ORDER BY step) AS rows_in,
       lag(rows_out) OVER (ORDER BY step) - rows_out AS removed
FROM s ORDER BY step"""


ORACLE: dict[str, str] = {
    "aggregate_by_area": _with(OV) + """
SELECT area_name, count(*) AS count,
       avg(CASE WHEN salary_from > 0 THEN salary_from END) AS avg_salary_from,
       avg(CASE WHEN salary_to > 0 THEN salary_to END) AS avg_salary_to,
       min(CASE WHEN salary_from > 0 THEN salary_from END) AS min_salary,
       max(CASE WHEN salary_to > 0 THEN salary_to END) AS max_salary
FROM ov GROUP BY area_name ORDER BY count DESC, area_name ASC NULLS LAST""",
    "aggregate_by_employer": _with(OV) + """
SELECT employer_name, count(*) AS vacancy_count,
       avg(CASE WHEN salary_from > 0 THEN salary_from END) AS avg_salary
FROM ov GROUP BY employer_name ORDER BY vacancy_count DESC, employer_name ASC NULLS LAST LIMIT 20""",
    "top_areas": _with(OV) + """
SELECT area_name, count(*) AS count, avg(salary_from) AS avg_from, avg(salary_to) AS avg_to
FROM ov WHERE area_name IS NOT NULL GROUP BY area_name
ORDER BY count DESC, area_name ASC LIMIT 10""",
    "salary_distribution": _with(OV) + f"""
SELECT {_band5()} AS salary_range, count(*) AS count
FROM ov WHERE salary_from > 0 GROUP BY salary_range ORDER BY min(salary_from)""",
    "percentile_salary": _with(OV) + """
SELECT area_name, percentile_cont(0.5) WITHIN GROUP (ORDER BY salary_from) AS median_salary,
       count(*) AS count
FROM ov WHERE salary_from > 0 AND area_name IS NOT NULL GROUP BY area_name
HAVING count(*) >= 5 ORDER BY median_salary DESC, area_name""",
    "area_avg_with_zeros": _with(OV) + """
SELECT area_name, count(*) AS count, avg(salary_from) AS avg_salary
FROM ov WHERE area_name IS NOT NULL GROUP BY area_name ORDER BY count DESC, area_name""",
    "area_counts_top15": _with(OV) + """
SELECT area_name, count(*) AS count FROM ov GROUP BY area_name
ORDER BY count DESC, area_name ASC NULLS LAST LIMIT 15""",
    "timeline": _with(OV) + """
SELECT substr(published_at, 1, 10) AS date, count(*) AS count FROM ov GROUP BY date ORDER BY date""",
    "headline": _with(OV) + """
SELECT count(*) AS vacancies,
       count(DISTINCT area_name) + max(CASE WHEN area_name IS NULL THEN 1 ELSE 0 END) AS areas,
       count(DISTINCT employer_name) + max(CASE WHEN employer_name IS NULL THEN 1 ELSE 0 END) AS employers,
       avg(CASE WHEN salary_from > 0 THEN salary_from END) AS avg_salary_from
FROM ov""",
    "employers_top10": _with(OV) + """
SELECT employer_name AS employer, count(*) AS vacancies,
       avg(CASE WHEN salary_from > 0 THEN salary_from END) AS avg_salary_from
FROM ov GROUP BY employer_name ORDER BY vacancies DESC, employer ASC NULLS LAST LIMIT 10""",
    "group_count_keep_null": _with(OV) + """
SELECT area_name, count(*) AS count FROM ov GROUP BY area_name ORDER BY count DESC""",
    "group_count_no_null": _with(OV) + """
SELECT area_name, count(*) AS count FROM ov WHERE area_name IS NOT NULL GROUP BY area_name
ORDER BY count DESC""",
    "salary_stats_by_area": _with(OV) + """
SELECT area_name, avg(salary_from) AS avg, min(salary_from) AS min, max(salary_from) AS max
FROM ov WHERE salary_from > 0 GROUP BY area_name ORDER BY avg DESC""",
    "salary_stats_by_area_sql": _with(OV) + """
SELECT area_name, avg(salary_from) AS avg, min(salary_from) AS min, max(salary_from) AS max
FROM ov WHERE salary_from > 0 AND area_name IS NOT NULL GROUP BY area_name ORDER BY avg DESC""",
    "median_cont_min3": _with(OV) + """
SELECT area_name, percentile_cont(0.5) WITHIN GROUP (ORDER BY salary_from) AS median
FROM ov WHERE salary_from > 0 AND area_name IS NOT NULL GROUP BY area_name
HAVING count(*) >= 3 ORDER BY median DESC""",
    "median_nearest": _with(OV) + """
, r AS (SELECT area_name, salary_from,
               row_number() OVER (PARTITION BY area_name ORDER BY salary_from) AS rn,
               count(*) OVER (PARTITION BY area_name) AS n
        FROM ov WHERE salary_from > 0)
SELECT area_name, CAST(salary_from AS DOUBLE) AS median FROM r
WHERE rn = floor((n - 1) * 0.5 + 0.5) + 1 ORDER BY median DESC""",
    "bench_top_areas": _with(OV) + """
SELECT area_name, count(*) AS cnt, avg(salary_from) AS avg_sal
FROM ov WHERE area_name IS NOT NULL GROUP BY area_name ORDER BY cnt DESC, area_name LIMIT 10""",
    "salary_distribution4": _with(OV) + f"""
SELECT {_band4()} AS range, count(*) AS cnt
FROM ov WHERE salary_from > 0 GROUP BY range ORDER BY min(salary_from)""",
    "salary_histogram30": _histogram(30),
    "salary_histogram25": _histogram(25),
    "salary_box_top10": _box(10),
    "salary_box_top8": _box(8),
    "top_area_rows": _with(OV) + """
, top AS (SELECT area_name FROM ov WHERE salary_from > 0 GROUP BY area_name
          ORDER BY count(*) DESC, area_name ASC NULLS LAST LIMIT 10)
SELECT id, area_name, salary_from FROM ov
WHERE salary_from > 0 AND area_name IN (SELECT area_name FROM top)""",
    "salary_accumulator": _with(OV) + """
, a AS (SELECT area_name, NULLIF(salary_from, 0) AS f, NULLIF(salary_to, 0) AS t FROM ov),
  b AS (SELECT *, (f IS NOT NULL OR t IS NOT NULL) AS h FROM a)
SELECT area_name, count(*) AS count,
       COALESCE(avg(CASE WHEN h THEN f END), 0.0) AS avg_from,
       COALESCE(avg(CASE WHEN h THEN t END), 0.0) AS avg_to,
       CAST(COALESCE(min(NULLIF(CASE WHEN h THEN f END, 0)), 0) AS BIGINT) AS min_from,
       CAST(greatest(COALESCE(max(CASE WHEN h THEN t END), 0), 0) AS BIGINT) AS max_to,
       count_if(h) AS with_salary
FROM b GROUP BY area_name""",
    "null_profile": _null_profile(),
    "stage_counts": _stage_counts(),
    "volume_report": _with(RV, DEDUP, CLEAN) + """
SELECT 'jsonl' AS format, count(*) AS rows, count(*) * 100 / 1048576.0 AS transport_mb_estimate FROM rv
UNION ALL SELECT 'parquet', count(*), count(*) * 100 / 1048576.0 FROM cl""",
    "dedup_first": _with(RV, DEDUP) + "SELECT id, name, collected_at, area_name FROM dd",
    "union_by_name": _with(OV, TV) + """
, u AS (SELECT id, name, area_name, salary_from, NULL AS employer_name FROM ov
        UNION ALL SELECT id, NULL, area_name, NULL, employer_name FROM tv)
SELECT area_name, count(*) AS rows, count(name) AS with_name, count(employer_name) AS with_employer,
       CAST(sum(salary_from) AS BIGINT) AS salary_sum
FROM u GROUP BY area_name""",
    "clean": _with(RV, DEDUP, CLEAN) + "SELECT * FROM cl",
    "available_columns": _with(RV, DEDUP, CLEAN) + """
SELECT id, name, area_name, employer_name, salary_from, salary_to, published_at FROM cl""",
    "area_salary_fallback": _msg_fallback(),
    "validate_base": _validated("base") + _VAL_OUT,
    "validate_extended": _validated("extended") + _VAL_OUT,
    "validation_text": _validated("base") + """
SELECT id, collected_at, array_to_string(errs, '; ') || '; ' AS error_text FROM va WHERE len(errs) > 0""",
    "valid_rows": _validated("base") + "SELECT id, collected_at, name FROM va WHERE len(errs) = 0",
    "validation_summary": _validated("base") + """
, sh AS (SELECT * FROM (VALUES (1, 'разработчик'), (2, 'разработчик'), (3, 'разработчик'),
                               (4, 'разработчик'), (5, 'data engineer'), (6, 'data engineer'))
         AS t(shard_id, query))
SELECT sh.shard_id, sh.query, count(*) AS total, count_if(len(errs) = 0) AS validated
FROM va JOIN sh ON CAST(CAST(va.id AS BIGINT) % 6 + 1 AS INTEGER) = sh.shard_id
GROUP BY sh.shard_id, sh.query""",
    "validation_errors": _validated("base") + """
SELECT error, count(*) AS count FROM (SELECT unnest(errs) AS error FROM va) GROUP BY error""",
    "skills_literal_top10": _with(TV) + ", " + _literal_skills_counts(_literal_keywords()) + """
SELECT skill, count FROM s WHERE count > 0 ORDER BY count DESC, skill LIMIT 10""",
    "skills_top20": _with(TV) + ", " + _literal_skills_counts(_literal_keywords()) + """
SELECT skill, count FROM s WHERE count > 0 ORDER BY count DESC, skill LIMIT 20""",
    "skills_regex": _with(TV) + ", " + _regex_skill_counts(_regex_keywords()) + """
SELECT skill, count FROM s WHERE count > 0 ORDER BY count DESC, skill""",
    "skills_by_area": _with(TV) + ", " + _literal_skills_counts(_literal_keywords(), by="area_name") + """
SELECT area_name, skill, count FROM s WHERE count > 0""",
    "tumbling_by_area": _tumbling_by_area("1 hour"),
    "tumbling_total": _tumbling_total("1 hour"),
    "tumbling_raw_by_area": _tumbling_raw_by_area("1 day"),
    "tumbling_top_skills": _tumbling_top_skills("1 hour"),
    "window_report": _window_report("1 hour"),
    "sliding_stats": _sliding_stats("6 hours", "1 hour", 6, 21600),
    "sliding_top5": _sliding_top5("6 hours", "1 hour", 6),
    "sliding_top_area": _sliding_top_area("6 hours", "1 hour", 6),
    "trailing_count": _with(EV) + """
SELECT id, ts, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 300 SECONDS PRECEDING AND CURRENT ROW)
       AS trailing_count
FROM ev""",
}


ORACLE.update({
    "jsonl_roundtrip": ORACLE["clean"],
    "parquet_roundtrip": _with(RV, DEDUP, CLEAN) + """
SELECT area_name, count(*) AS count, avg(salary_from) AS avg_from, avg(salary_to) AS avg_to
FROM cl WHERE area_name IS NOT NULL GROUP BY area_name""",
    "message_decode": _with(RV) + """
SELECT id, COALESCE(area_name, 'Unknown') AS area, COALESCE(CASE WHEN has_salary THEN sf END, 0) AS salary
FROM rv""",
    "page_unwrap": _with(RV) + """
SELECT id, name, area_name, '2025-05-01T10:01:00Z' AS collected_at FROM rv""",
    "stream_tumbling": ORACLE["window_report"],
    "stream_sliding": ORACLE["sliding_stats"],
    "fan_out": """
SELECT event_type AS area_name, count(*) AS count,
       CAST(sum(CAST(floor(value * 1000) AS BIGINT)) AS BIGINT) AS salary_sum,
       (SELECT count(*) FROM events) AS messages
FROM events GROUP BY event_type""",
    "report_readback": ORACLE["window_report"],
})


ORACLE.update({
    "profile_head": _with(RV, DEDUP, CLEAN) + "SELECT * FROM cl ORDER BY id LIMIT 5",
    "profile_shape": _with(RV, DEDUP, CLEAN) + "SELECT count(*) AS rows, 9 AS columns FROM cl",
    "quarantine_rows": _validated("base") + """
SELECT id, collected_at, area_id, array_to_string(errs, '; ') || '; ' AS error_text
FROM va WHERE len(errs) > 0""",
})


ORACLE.update({
    "stream_messages": _with(RV) + f""", x AS (
  SELECT time_bucket(INTERVAL '1 day', cts) - i * INTERVAL '1 day' AS ws, area_name AS area,
         CASE WHEN has_salary AND sf > 0 THEN sf END AS pos
  FROM rv, range(7) AS r(i)),
  ba AS (SELECT ws, area, count(*) AS cnt, sum(pos) AS salary_sum, count(pos) AS salary_n
         FROM x GROUP BY ws, area)
SELECT strftime(ws, {ISO}) AS window_start, strftime(ws + INTERVAL '7 days', {ISO}) AS window_end,
       604800 AS window_sec, CAST(sum(cnt) AS BIGINT) AS total,
       COALESCE(CAST(sum(salary_sum) AS DOUBLE) / sum(salary_n), 0.0) AS avg_salary_from,
       arg_min(area, (-cnt, area)) AS top_area, CAST(max(cnt) AS BIGINT) AS top_area_count
FROM ba GROUP BY ws""",
})


_COMMON = ["the", "a", "e", "i", "o", "t", "n", "s", "r", "l", "qz"]
_FIRST = CLEAN.replace("FROM rv)", "FROM rv WHERE has_salary)").replace("cl AS", "cf AS")

ORACLE.update({
    "jsonl_bad_input": _with(RV) + """
, b AS (SELECT *, substr(published_at, 1, 9) AS part,
               CAST(id AS BIGINT) % 1009 = 0
                 OR (CAST(id AS BIGINT) % 1013 = 0 AND has_salary) AS bad FROM rv)
SELECT 'drop_row' AS mode, area_name, count(*) AS rows FROM b WHERE NOT bad GROUP BY area_name
UNION ALL
SELECT 'drop_file', area_name, count(*) FROM b
WHERE part NOT IN (SELECT part FROM b WHERE bad) GROUP BY area_name""",
    "schema_inferred": ORACLE["union_by_name"],
    "jsonl_stream_sink": """
SELECT event_type AS area_name, count(*) AS count,
       CAST(sum(CAST(floor(value * 1000) AS BIGINT)) AS BIGINT) AS salary_sum,
       CAST(0 AS BIGINT) AS files_too_long
FROM events GROUP BY event_type""",
    "snapshot": _with(RV, CLEAN, _FIRST) + """
SELECT 'first' AS step, area_name, count(*) AS rows FROM cf GROUP BY area_name
UNION ALL SELECT 'kept', area_name, count(*) FROM cf GROUP BY area_name
UNION ALL SELECT 'refreshed', area_name, count(*) FROM cl GROUP BY area_name""",
    "stream_append": ORACLE["window_report"],
    "stream_sliding_append": ORACLE["sliding_stats"],
    "skills_tied_top5": _with(TV) + ", " + _literal_skills_counts(_COMMON) + """
SELECT skill, count FROM s WHERE count > 0 ORDER BY count DESC, skill LIMIT 5""",
})


_BROKEN = _with(RV, DEDUP, CLEAN) + """
, b AS (SELECT *, substr(published_at, 1, 9) AS part,
               CAST(id AS BIGINT) % 1009 = 0
                 OR (CAST(id AS BIGINT) % 1013 = 0 AND has_salary) AS bad FROM rv),
  k AS (SELECT * FROM b WHERE part NOT IN (SELECT part FROM b WHERE bad))
"""

_SPARSE = _sliding_by_area("10 minutes", "5 minutes", 2) + f""", st AS (
  SELECT ws, CAST(sum(cnt) AS BIGINT) AS total,
         COALESCE(CAST(sum(salary_sum) AS DOUBLE) / sum(salary_n), 0.0) AS avg_salary_from,
         arg_min(area, (-cnt, area)) AS top_area, CAST(max(cnt) AS BIGINT) AS top_area_count
  FROM ba GROUP BY ws),
  spine AS (SELECT unnest(generate_series((SELECT min(ws) FROM st), (SELECT max(ws) FROM st), INTERVAL '5 minutes')) AS ws)
SELECT strftime(spine.ws, {ISO}) AS window_start, strftime(spine.ws + INTERVAL '10 minutes', {ISO}) AS window_end,
       600 AS window_sec, COALESCE(total, 0) AS total, COALESCE(avg_salary_from, 0.0) AS avg_salary_from,
       CASE WHEN total IS NULL THEN '' ELSE top_area END AS top_area, COALESCE(top_area_count, 0) AS top_area_count
FROM spine LEFT JOIN st ON st.ws = spine.ws"""

ORACLE.update({
    "jsonl_staged": _BROKEN + """
SELECT area_name, count(*) AS rows, (SELECT count(*) FROM b) AS lines, (SELECT count(*) FROM b WHERE bad) AS bad_lines,
       (SELECT count(*) FROM k) AS kept_lines, (SELECT count(DISTINCT part) FROM b WHERE bad) AS bad_files
FROM k GROUP BY area_name""",
    "schema_inferred_bad": """
WITH u AS (
  SELECT o_orderkey AS id, floor(o_totalprice) AS amount, o_orderstatus AS kind, NULL AS item FROM orders
  UNION ALL
  SELECT l_orderkey, l_linenumber, NULL, l_linestatus FROM lineitem
  WHERE l_orderkey % 10 <> 3 OR NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey % 10 = 3 AND x.l_linenumber = 1))
SELECT id % 10 AS digit, count(*) AS rows, count(kind) AS with_kind, count(item) AS with_items,
       CAST(-1 AS BIGINT) AS with_docs, CAST(sum(amount) AS BIGINT) AS amounts, 'double' AS amount_type
FROM u GROUP BY id % 10""",
    "parquet_clustered": _with(RV, DEDUP, CLEAN) + """
SELECT area_name, count(*) AS rows, 0 AS too_many_files FROM cl GROUP BY area_name""",
    "message_rejects": """
SELECT 'records' AS source, (SELECT count(*) FROM lineitem) AS decoded, CAST(0 AS BIGINT) AS rejected
UNION ALL SELECT 'cut', CAST(0 AS BIGINT), (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'twice', CAST(0 AS BIGINT), (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'documents', CAST(0 AS BIGINT), (SELECT count(*) FROM documents)""",
    "stream_late_counts": """
WITH w AS (SELECT max(ts) - INTERVAL '1 hour' AS wm FROM events WHERE event_id % 10 <> 0),
  l AS (SELECT count(*) AS late FROM events, w
        WHERE event_id % 10 = 0 AND time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= wm)
SELECT (SELECT count(*) FROM events) AS received, (SELECT count(*) FROM events) - late AS reported, late,
       CAST(late > 0 AS INTEGER) AS late_noted FROM l""",
    "sliding_spine": _SPARSE,
    "stream_sliding_spine": _SPARSE,
    "stream_trailing_count": """
SELECT CAST(event_id AS VARCHAR) AS id, ts, CAST(1 AS BIGINT) AS rows, trailing_count
FROM (SELECT event_id, ts, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 300 SECONDS PRECEDING AND CURRENT ROW)
             AS trailing_count FROM events)
WHERE ts < (SELECT max(ts) FROM events) - INTERVAL '2 hours'""",
    "stream_collect": _validated("base") + """
SELECT area_name, count(*) AS files, count(*) AS messages, count(*) AS windowed
FROM va WHERE len(errs) = 0 GROUP BY area_name""",
    "analyze_stages": _BROKEN + """
, n AS (SELECT name FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY collected_at NULLS FIRST, name NULLS FIRST) = 1),
  s AS (SELECT CAST(0 AS INTEGER) AS step, 'lines' AS stage, count(*) AS rows_out FROM b
        UNION ALL SELECT 1, 'load', count(*) FROM k
        UNION ALL SELECT 2, 'dedup', count(*) FROM n
        UNION ALL SELECT 3, 'clean', count(*) FROM n WHERE name IS NOT NULL AND length(name) >= 3)
SELECT step, stage, lag(rows_out) OVER (ORDER BY step) AS rows_in, rows_out,
       lag(rows_out) OVER (ORDER BY step) - rows_out AS removed
FROM s""",
})
