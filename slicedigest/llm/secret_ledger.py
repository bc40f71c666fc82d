"""Secret scanning with a ledger of the blobs that each version of each rule has seen. Column expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.runtime import materialise

LEDGER = "blob binary, rule string, rule_version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length decides, and the least length. ``rank`` orders rules that start at one place."""

    name: str
    version: int
    pattern: str
    group: int
    least: int


RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
"""Fixed values. A run of hex digits is matched from the least length on, which finds the same runs at less cost."""


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def match_spans(content: str, rule: Rule) -> F.Column:
    """Code-point spans of the rule's leftmost matches that are long enough, in order.

    The pieces between matches and the matches themselves make up the text, so their lengths give the places.
    """
    c, p = f"`{content}`", _sql(rule.pattern)
    none = "cast(array() AS array<struct<start:int,end:int,held:int>>)"
    gaps = f"transform(split({c}, {p}, -1), x -> length(x))"
    sizes = f"transform(regexp_extract_all({c}, {p}, 0), x -> length(x))"
    held = f"transform(regexp_extract_all({c}, {p}, {rule.group}), x -> length(x))"
    steps = f"""zip_with({gaps}, zip_with({sizes}, {held}, (s, h) -> struct(s AS size, h AS held)),
        (g, m) -> struct(g AS gap, m.size AS size, m.held AS held))"""  # the gap behind the last match has no match
    return F.expr(f"""CASE WHEN {c} RLIKE {p} THEN filter(aggregate({steps},
        struct(0 AS at, {none} AS found),
        (s, x) -> struct(
            s.at + x.gap + coalesce(x.size, 0) AS at,
            if(x.size IS NULL, s.found, concat(s.found, array(struct(
                s.at + x.gap AS start, s.at + x.gap + x.size AS end, x.held AS held)))) AS found),
        s -> s.found), f -> f.held >= {rule.least}) ELSE {none} END""")


def blob_id(content: str = "content") -> F.Column:
    """The content's address: its SHA-256."""
    return F.unhex(F.sha2(F.encode(F.col(content), "UTF-8"), 256))


def scan_blobs(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows for the pairs of blob and rule version that the ledger lacks.

    ``versions`` has ``content``, one row per version of a path. Contents that are equal are one blob, kept once per task
    before they are shuffled, and each is read by the rules that have not seen it. A blob without findings gets rows too: it
    has been seen. Null content is empty.
    """
    texts = versions.select(F.coalesce(F.col("content"), F.lit("")).alias("content")).withColumn("blob", blob_id())
    blobs = texts.groupBy("blob").agg(F.first("content").alias("content"))
    todo = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        blobs = blobs.withColumn("todo", todo)
    else:
        now = F.lit(False)
        for r in rules:
            now = now | ((F.col("rule") == r.name) & (F.col("rule_version") == r.version))
        seen = ledger.where(now).groupBy("blob").agg(F.collect_set("rule").alias("seen"))  # at most one entry per rule
        blobs = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(todo, F.coalesce("seen", F.array().cast("array<string>"))))
        blobs = blobs.where(F.size("todo") > 0)
    found = [
        F.when(
            F.array_contains("todo", r.name),
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.version).alias("rule_version"),
                F.transform(match_spans("content", r), lambda x: F.struct(x["start"], x["end"])).alias("spans"),
            ),
        )
        for r in rules
    ]
    rows = blobs.select("blob", F.explode(F.array_compact(F.array(*found))).alias("f"))
    return rows.select("blob", "f.rule", "f.rule_version", F.col("f.spans").cast("array<struct<start:int,end:int>>").alias("spans"))


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``versions`` with ``blob`` and ``found``, the spans of all current rules by start and rule order.

    Blobs without findings are left out of the join, so the ledger's side has few rows, written first so that both sides of the
    join are plain shuffles and Spark can split a blob that many paths have; no text is shuffled.
    """
    current = F.lit(False)
    rank = F.lit(None).cast("int")
    for i, r in enumerate(rules):
        current = current | ((F.col("rule") == r.name) & (F.col("rule_version") == r.version))
        rank = F.coalesce(rank, F.when(F.col("rule") == r.name, F.lit(i)))
    hits = (
        ledger.where(current & (F.size("spans") > 0))
        .select("blob", "rule", rank.alias("rank"), "spans")
        .dropDuplicates(["blob", "rule"])
        .select("blob", F.transform("spans", lambda x: F.struct(x["start"].alias("start"), F.col("rank").alias("rank"), x["end"].alias("end"), F.col("rule").alias("rule"))).alias("part"))
        .groupBy("blob")
        .agg(F.sort_array(F.flatten(F.collect_list("part"))).alias("found"))  # one entry per rule
    )
    return versions.drop("found").join(materialise(hits), "blob", "left")


def scan_paths(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Scan what is new and join the findings to all paths: ``(rows with blob and found, new ledger rows)``.

    All columns of ``versions`` but ``content`` come back, those named ``blob`` or ``found`` replaced; ``found`` is null where a
    version has no finding. Write the new
    rows behind the ledger and pass both the next time.
    """
    new = materialise(scan_blobs(versions, ledger, rules))  # scanned once, for the findings and for the ledger
    whole = new if ledger is None else ledger.select(new.columns).unionByName(new)
    paths = versions.withColumn("content", F.coalesce("content", F.lit(""))).withColumn("blob", blob_id()).drop("content")
    return findings(paths, whole, rules), new


def span_text(found: str = "found") -> F.Column:
    """``kind:start:end`` of every span, joined by commas; empty where there is none."""
    parts = F.transform(F.col(found), lambda x: F.concat_ws(":", x["rule"], x["start"].cast("string"), x["end"].cast("string")))
    return F.coalesce(F.array_join(parts, ","), F.lit(""))


def span_count(rule: str, found: str = "found") -> F.Column:
    return F.coalesce(F.size(F.filter(F.col(found), lambda x: x["rule"] == rule)), F.lit(0)).cast("bigint")


def redact(content: str, found: str = "found", mark: str = "[secret]") -> F.Column:
    """The content with every found span replaced by ``mark``; overlapping spans become one."""
    merged = f"""aggregate(coalesce(`{found}`, array()), cast(array() AS array<struct<start:int,end:int>>),
        (m, x) -> if(size(m) > 0 AND x.start < m[size(m) - 1].end,
            concat(slice(m, 1, size(m) - 1), array(struct(m[size(m) - 1].start AS start, greatest(m[size(m) - 1].end, x.end) AS end))),
            concat(m, array(struct(x.start AS start, x.end AS end)))))"""
    return F.expr(f"""if(size(`{found}`) > 0, concat_ws('', aggregate({merged},
        struct(0 AS at, cast(array() AS array<string>) AS parts),
        (s, x) -> struct(x.end AS at, concat(s.parts, array(substring(`{content}`, s.at + 1, x.start - s.at), {_sql(mark)})) AS parts),
        s -> concat(s.parts, array(substring(`{content}`, s.at + 1))))), `{content}`)""")
