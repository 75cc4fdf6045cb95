"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed (SHA-256 of its text). The ledger, a folder of two
Parquet tables, knows which (blob, rule, rule version) were scanned and what was found. A scan takes
each distinct text once, scans it only for the pairs the ledger lacks, adds to the ledger and joins
the findings back to all paths, so copies and unchanged history cost a hash.

Positions come from the JVM's own regular expressions: the pieces between matches and the matches
themselves give, summed up in order, the start of every match in code points. Matches are leftmost
and do not overlap within a rule; those shorter than the rule's least length are dropped afterwards.

Defined results: a null text is the empty text; repeated rows are paths of one blob; other columns
never clash, as only the path columns and ``text`` are read; an empty table adds nothing. Findings
are written before the list of scanned pairs: a scan that breaks off in between is scanned again,
and reading the findings drops what is then there twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import persist
from tessera.session import path_exists, scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int          # characters of the group that decides
    group: int = 0
    version: int = 1


# The base rules, in their order.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
#: Further well-known forms.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
)
RULES = BASE_RULES + MORE_RULES
#: Up to so many new blobs (about 120 bytes each) are sent to all tasks.
FEW_BLOBS = 200_000
SCANNED = "blob string, kind string, version int"
FOUND = "blob string, kind string, version int, start long, end long"


def _screen(rule: Rule) -> str:
    """A pattern that every kept match of the rule matches, and few other texts do.

    For literal text and one repeated class the least length can be written into the pattern: the
    first match in a run is its longest. Other rules are screened by their own pattern.
    """
    literal, bracket, rest = rule.pattern.partition("[")
    if rule.group or not rest.endswith("]+") or "[" in rest or not literal.isalnum() and literal:
        return rule.pattern
    return f"{literal}{bracket}{rest[:-1]}{{{rule.least - len(literal)},}}"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(text: Column, rule: Rule) -> Column:
    """array<struct<gap, size, deciding>>: lengths of the text before each match since the one before,
    of the match, and of the group that decides; a last element has the text after the last match."""
    lengths = lambda parts: F.transform(parts, F.char_length)
    pattern = F.lit(rule.pattern)
    sizes = lengths(F.regexp_extract_all(text, pattern, F.lit(0)))
    deciding = lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))) if rule.group else sizes
    return F.arrays_zip(lengths(F.split(text, rule.pattern, -1)).alias("gap"), sizes.alias("size"), deciding.alias("deciding"))


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, pending: Column | None = None) -> DataFrame:
    """(blob, kind, version, start, end) in ``blobs`` (blob, text). ``pending`` (array of kinds) limits the rules."""
    text = F.col("text")
    per_rule = []
    for k, rule in enumerate(rules):
        wanted = text.rlike(_screen(rule))
        if pending is not None:
            wanted = F.array_contains(pending, rule.kind) & wanted
        per_rule.append(F.struct(F.lit(k).alias("rule"), F.when(wanted, _matches(text, rule)).alias("matches")))
    each = blobs.select("blob", F.explode(F.array(*per_rule)).alias("r")).filter("r.matches IS NOT NULL")
    each = each.select("blob", F.col("r.rule").alias("rule"), F.posexplode("r.matches").alias("at", "m")).select(
        "blob", "rule", "at", F.col("m")["gap"].alias("gap"), F.col("m")["size"].alias("size"), F.col("m")["deciding"].alias("deciding"))
    order = Window.partitionBy("blob", "rule").orderBy("at")
    before = F.sum(F.col("gap").cast("long")).over(order) + F.coalesce(
        F.sum(F.col("size").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.col("rule") + 1)
    kind = F.element_at(F.array(*(F.lit(r.kind) for r in rules)), F.col("rule") + 1)
    version = F.element_at(F.array(*(F.lit(r.version) for r in rules)), F.col("rule") + 1)
    return (each.withColumn("start", before).filter((F.col("size") > 0) & (F.col("deciding") >= least))
                .select("blob", kind.alias("kind"), version.alias("version"), "start",
                        (F.col("start") + F.col("size")).alias("end")))


class Ledger:
    """What was scanned and found so far, under one shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED)

    def findings(self) -> DataFrame:
        return self._read("findings", FOUND).distinct()

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new in ``versions`` (any columns, ``text`` among them)."""
        rows = versions.select(blob_id(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
        # Copies collapse before the shuffle: each task hands on one row per distinct text.
        texts, pending = rows.dropDuplicates(["blob"]), None
        if path_exists(self.spark, f"{self.path}/scanned"):
            known = F.broadcast(self.spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int"))
            done = self.scanned().join(known, ["kind", "version"]).groupBy("blob").agg(F.collect_set("kind").alias("done"))
            left = F.array_except(F.array(*(F.lit(r.kind) for r in rules)), F.coalesce("done", F.array().cast("array<string>")))
            new = persist(rows.select("blob").distinct().join(done, "blob", "left").select("blob", left.alias("pending"))
                              .filter(F.size("pending") > 0), "secrets-pending")
            # A few new blobs: known texts are not even shuffled. Many: by a join after the copies have collapsed.
            few = new.count() <= FEW_BLOBS
            texts = rows.join(F.broadcast(new), "blob").dropDuplicates(["blob"]) if few else texts.join(new, "blob")
            pending = F.col("pending")
        name = scratch_path(self.spark, "secrets-new")
        find(texts, rules, pending).write.parquet(name)
        self.spark.read.schema(FOUND).parquet(name).write.mode("append").parquet(f"{self.path}/findings")
        blobs = versions.select(blob_id(F.col("text")).alias("blob")).distinct()
        rule_rows = F.explode(F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules)))
        new = blobs.select("blob", rule_rows.alias("r")).select("blob", "r.kind", "r.version").join(
            self.scanned(), ["blob", "kind", "version"], "left_anti")
        persist(new, "secrets-scanned").write.mode("append").parquet(f"{self.path}/scanned")

    def of_paths(self, versions: DataFrame, paths: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(*paths, spans): the findings of the given rules for every row, as an array of
        (start, rule number, kind, end) sorted by start and rule."""
        known = self.spark.createDataFrame([(k, r.kind, r.version) for k, r in enumerate(rules)], "rule int, kind string, version int")
        per_blob = (self.findings().join(F.broadcast(known), ["kind", "version"]).groupBy("blob")
                        .agg(F.array_sort(F.collect_list(F.struct("start", "rule", "kind", "end"))).alias("spans")))
        # Written first, so that the join has plain exchanges on both sides and Spark can split a blob with many paths.
        per_blob = persist(per_blob, "secrets-per-blob")
        return versions.select(*paths, blob_id(F.col("text")).alias("blob")).join(per_blob, "blob", "left").select(*paths, "spans")


def _written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.coalesce(F.array_join(F.transform(spans, one), ","), F.lit(""))


def secret_report(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs``."""
    spark = docs.sparkSession
    ledger = Ledger(spark, ledger_path or scratch_path(spark, "secret-ledger"))
    ledger.scan(docs)
    found = ledger.of_paths(docs, ("doc_id",))
    base = F.filter("spans", lambda s: s["rule"] < len(BASE_RULES))
    count = lambda k: F.coalesce(F.size(F.filter("spans", lambda s: s["rule"] == k)), F.lit(0))
    return found.select("doc_id", *(F.when(F.col("spans").isNull(), 0).otherwise(count(k)).cast("long").alias(f"n_{r.kind}")
                                    for k, r in enumerate(BASE_RULES)),
                        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def _oracle() -> str:
    """The same report in DuckDB's SQL."""
    parts = []
    for k, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT id, {k} AS rule, '{r.kind}' AS kind, nth, size, start FROM (
    SELECT id, nth, size, deciding, (sum(gap) OVER w + sum(size) OVER w - size)::BIGINT AS start FROM (
      SELECT id, unnest(range(len(m))) AS nth, unnest(list_transform(m, lambda s: length(s))) AS size,
             unnest(list_transform(v, lambda s: length(s))) AS deciding,
             unnest(list_transform(g[1:len(m)], lambda s: length(s))) AS gap
      FROM (SELECT id, regexp_extract_all(x, '{pattern}', 0) AS m, regexp_extract_all(x, '{pattern}', {r.group}) AS v,
                   string_split_regex(x, '{pattern}') AS g FROM t WHERE regexp_matches(x, '{pattern}')))
    WINDOW w AS (PARTITION BY id ORDER BY nth)) WHERE deciding >= {r.least}""")
    written = "string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, rule)"
    counts = ", ".join(f"coalesce(count(rule) FILTER (rule = {k}), 0) AS n_{r.kind}" for k, r in enumerate(BASE_RULES))
    return f"""
WITH t AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS x FROM documents),
s AS ({' UNION ALL '.join(parts)})
SELECT doc_id, {counts},
       sha256(coalesce({written} FILTER (rule < {len(BASE_RULES)}), '')) AS base_sha256,
       coalesce({written}, '') AS spans
FROM t LEFT JOIN s USING (id) GROUP BY id, doc_id"""


ORACLE = _oracle()
