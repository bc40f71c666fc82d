"""The whole plan as one recursive SQL query, over counts of ``profile, alias, pos, cols, key, rows``."""

from __future__ import annotations


def label(first: str, last: str, precision: str) -> str:
    d = lambda k: f"lpad(({k})::VARCHAR, 8, '0')"
    text = lambda k: f"CASE {precision} WHEN 'year' THEN substr({d(k)}, 1, 4) WHEN 'month' THEN substr({d(k)}, 1, 4) || '-' || substr({d(k)}, 5, 2) ELSE substr({d(k)}, 1, 4) || '-' || substr({d(k)}, 5, 2) || '-' || substr({d(k)}, 7, 2) END"
    return (
        f"CASE WHEN {first} IS NULL THEN NULL WHEN {first} = {last} THEN {text(first)} WHEN {precision} = 'month' AND {first} // 10000 = {last} // 10000 "
        f"THEN {text(first)} || '~' || substr({d(last)}, 5, 2) ELSE {text(first)} || '~' || {text(last)} END"
    )


def padded(number: str, width: int, whole: bool) -> str:
    """A number with zeros ahead of it. ``lpad`` cuts off what is longer; ``whole`` keeps it, as a template's ``03d`` does."""
    text = f"({number})::VARCHAR" if "+" in number else f"{number}::VARCHAR"
    return f"lpad({text}, greatest({width}, length({text}))::INT, '0')" if whole else f"lpad({text}, {width}, '0')"


def plan_ctes(
    counts: str, limit: int, budget: int, base: str = "year", algorithm: str = "calendar_greedy", descending: bool = False, whole: bool = False
) -> str:
    """``whole`` keeps every digit of the numbers in names, however many workbooks or parts there are."""
    sign = "-" if descending else ""
    year = "true" if base == "year" else "false"
    precision = {"year": "year", "year-month": "month", "year-month-day": "day"}[base]
    alone = "true" if algorithm == "calendar_periods" else "false"
    return f"""WITH RECURSIVE counts AS MATERIALIZED ({counts}),
    cap AS (SELECT *, least({limit}, {budget} // cols - 1) AS cap FROM (SELECT profile, alias, pos, cols, sum(rows)::BIGINT AS n FROM counts GROUP BY ALL)),
    one AS (SELECT profile, bool_and(n <= cap OR n = 0) AND sum(cols * (n + 1)) <= {budget} AS single FROM cap GROUP BY profile),
    base AS MATERIALIZED (SELECT profile, alias, CASE WHEN {year} THEN key // 10000 * 10000 ELSE key END AS bkey, sum(rows)::BIGINT AS rows FROM counts GROUP BY ALL),
    cells AS MATERIALIZED (SELECT profile, alias, key // 10000 * 10000 AS bkey, g, (key // 100 % 100 - 1) // g AS cell, sum(rows)::BIGINT AS rows
      FROM counts, (SELECT unnest([6, 4, 3, 2, 1]) AS g) WHERE key IS NOT NULL GROUP BY ALL),
    fits AS MATERIALIZED (SELECT profile, alias, bkey, g, bool_and(rows <= cap) AS fits FROM cells JOIN cap USING (profile, alias) GROUP BY ALL),
    pick AS MATERIALIZED (SELECT profile, alias, bkey, coalesce(max(g) FILTER (WHERE fits), 1) AS g FROM fits GROUP BY ALL),
    big AS MATERIALIZED (SELECT profile, alias, bkey FROM base JOIN cap USING (profile, alias) WHERE {year} AND bkey IS NOT NULL AND rows > cap),
    groups AS MATERIALIZED (SELECT profile, alias, bkey AS first, bkey AS last, CASE WHEN bkey IS NOT NULL THEN '{precision}' END AS precision, rows, bkey IS NULL OR {alone} AS sealed
        FROM base WHERE (profile, alias, coalesce(bkey, 0)) NOT IN (SELECT (profile, alias, bkey) FROM big)
      UNION ALL SELECT profile, alias, (bkey + (cell * g + 1) * 100)::BIGINT, (bkey + (cell + 1) * g * 100)::BIGINT, 'month', rows, true
        FROM cells JOIN pick USING (profile, alias, bkey, g) JOIN big USING (profile, alias, bkey)),
    ordered AS MATERIALIZED (SELECT g.*, cap, row_number() OVER (PARTITION BY profile, alias ORDER BY first IS NULL, {sign}first) AS i FROM groups g JOIN cap USING (profile, alias)),
    run AS (SELECT profile, alias, i, 1 AS no, rows AS used, NOT (sealed OR rows > cap) AS open FROM ordered WHERE i = 1
      UNION ALL SELECT o.profile, o.alias, o.i, CASE WHEN o.sealed OR o.rows > cap OR NOT open OR used + o.rows > cap THEN no + 1 ELSE no END,
        CASE WHEN o.sealed OR o.rows > cap OR NOT open OR used + o.rows > cap THEN o.rows ELSE used + o.rows END, NOT (o.sealed OR o.rows > cap)
      FROM run r JOIN ordered o ON o.profile = r.profile AND o.alias = r.alias AND o.i = r.i + 1),
    merged AS MATERIALIZED (SELECT profile, alias, no AS group_no, bool_or(first IS NULL) AND sum(rows) > 0 AS undated, min(first) AS first, max(last) AS last, max(precision) AS precision, sum(rows)::BIGINT AS rows
      FROM ordered JOIN run USING (profile, alias, i) GROUP BY ALL),
    parted AS (SELECT m.*, pos, cols, greatest(1, (rows + cap - 1) // cap) AS parts FROM merged m JOIN cap USING (profile, alias) JOIN one USING (profile) WHERE NOT single),
    grp AS (SELECT profile, alias, pos, cols, group_no, CASE WHEN undated THEN 'undated' WHEN parts > 1 THEN 'overflow' ELSE 'period' END AS kind, first, last, precision, rows, parts FROM parted
      UNION ALL SELECT profile, alias, pos, cols, 1, 'single', NULL, NULL, NULL, n, 1 FROM cap JOIN one USING (profile) WHERE single),
    sheets0 AS (SELECT *, unnest(range(parts)) AS part FROM grp),
    sheets AS MATERIALIZED (SELECT profile, alias, pos, cols, group_no, kind, first, last, precision, parts, part, rows AS group_rows, rows // parts + CASE WHEN part < rows % parts THEN 1 ELSE 0 END AS rows,
      row_number() OVER (PARTITION BY profile ORDER BY kind = 'undated', coalesce({sign}first, 0), pos, group_no, part) AS s FROM sheets0),
    pack AS (SELECT profile, s, 1 AS book, cols * (rows + 1) AS used FROM sheets WHERE s = 1
      UNION ALL SELECT x.profile, x.s, CASE WHEN used + x.cols * (x.rows + 1) > {budget} THEN book + 1 ELSE book END,
        CASE WHEN used + x.cols * (x.rows + 1) > {budget} THEN x.cols * (x.rows + 1) ELSE used + x.cols * (x.rows + 1) END
      FROM pack p JOIN sheets x ON x.profile = p.profile AND x.s = p.s + 1),
    laid AS MATERIALIZED (SELECT sheets.*, book AS workbook_index, row_number() OVER (PARTITION BY profile, book ORDER BY s) AS sheet_index,
      coalesce(sum(rows) OVER (PARTITION BY profile, alias ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM sheets JOIN pack USING (profile, s)),
    grain AS (SELECT profile, workbook_index, CASE min(CASE precision WHEN 'year' THEN 0 WHEN 'month' THEN 1 WHEN 'day' THEN 2 END) WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'day' END AS p,
      min(first) AS f0, max(last) AS l0, bool_or(kind = 'undated') AS u FROM laid GROUP BY ALL),
    books AS (SELECT *, CASE p WHEN 'year' THEN f0 // 10000 * 10000 WHEN 'month' THEN f0 // 100 * 100 ELSE f0 END AS f, CASE p WHEN 'year' THEN l0 // 10000 * 10000 WHEN 'month' THEN l0 // 100 * 100 ELSE l0 END AS l FROM grain),
    labelled AS (SELECT laid.*, {label("first", "last", "precision")} AS lab, profile || '_' || CASE WHEN f IS NULL THEN CASE WHEN u THEN 'Undated' ELSE 'Data' END ELSE {label("f", "l", "p")} || CASE WHEN u THEN '_Undated' ELSE '' END END
      || '_' || {padded("workbook_index", 3, whole)} || '.xlsx' AS workbook FROM laid JOIN books USING (profile, workbook_index)),
    titled AS (SELECT *, alias || ' ' || CASE kind WHEN 'single' THEN 'Data' WHEN 'undated' THEN 'Undated' WHEN 'overflow' THEN lab || '_p' || {padded("part + 1", 2, whole)} ELSE coalesce(lab, 'Data') END AS title FROM labelled),
    plan AS MATERIALIZED (SELECT *, CASE WHEN kind = 'undated' THEN 'Undated' ELSE lab END AS period_label,
      title || CASE WHEN row_number() OVER (PARTITION BY profile, workbook, lower(title) ORDER BY s) > 1 THEN '_' || row_number() OVER (PARTITION BY profile, workbook, lower(title) ORDER BY s) ELSE '' END AS sheet FROM titled)"""


PLAN = "profile, alias, group_no::INT AS group_no, part::INT AS part, kind, first::INT AS first, last::INT AS last, precision, rows, start, workbook_index, sheet_index, cols * (rows + 1) AS cells, workbook, sheet, period_label"
PLAN_COLUMNS = ["profile", "alias", "group_no", "part", "kind", "first", "last", "precision", "rows", "start", "workbook_index", "sheet_index", "cells", "workbook", "sheet", "period_label"]


def plan_select(*args, **kwargs) -> str:
    return f"{plan_ctes(*args, **kwargs)} SELECT {PLAN} FROM plan"
