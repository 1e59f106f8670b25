"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. The ledger remembers which (blob, rule version)
pairs were scanned; a run scans only pairs it has not seen, stores findings per blob, and joins findings back to every path
and version that holds the blob. A copy is never scanned twice, a changed rule rescans only itself.

All of it is DataFrame expressions. Spark gives matched strings but not their places, so a text is cut at the matches and
the places are running totals of the lengths of cuts and matches.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.llm.frames import whole_text

LEDGER = "blob string, kind string, rule_version int, run string"
FINDINGS = "blob string, kind string, rule_version int, start long, end long, run string"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds candidates, leftmost and without overlap; one whose ``group`` is shorter than ``shortest`` goes.

    The finding is the group ``span``, which ends where the match ends. Patterns repeat no group (the regex engine recurses once per
    repetition, and a long text would end the process) and look at a run of characters from one place only, so that any text
    takes linear time.
    """

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 1
    version: int = 1
    span: int = 0


#: The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
#: Well-known credential formats beyond the base.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", version=2),
    Rule("jwt", r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)", 1, version=2, span=1),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("login", r"://[^\s:/@]+:[^\s:/@]+@"),
)
RULES = BASE_RULES + MORE_RULES


def _lengths(text: Column, rule: Rule) -> Column:
    """Lengths (code points) of the cuts between matches, of the matches, and of the group that decides."""
    found = lambda g: F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(g)), F.length)
    return F.struct(
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.version).alias("rule_version"),
        F.lit(rule.shortest).alias("shortest"),
        F.arrays_zip(
            F.transform(F.split(text, rule.pattern, -1), F.length).alias("cut"),
            found(0).alias("whole"),
            found(rule.group).alias("part"),
            found(rule.span).alias("span"),
        ).alias("pieces"),
    )


def scan_blobs(pending: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings (blob, kind, rule_version, start, end) of ``pending`` (blob, text, todo: names of the rules to scan)."""
    hits = [
        F.when(F.array_contains("todo", _name(r)) & F.col("text").rlike(_quick(r)), _lengths(F.col("text"), r))
        for r in rules
    ]
    each = pending.select("blob", F.explode(F.array_compact(F.array(*hits))).alias("hit")).select(
        "blob", "hit.kind", "hit.rule_version", "hit.shortest", F.posexplode("hit.pieces").alias("place", "piece")
    )
    upto = Window.partitionBy("blob", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("piece.cut").cast("long") + F.coalesce(F.col("piece.whole"), F.lit(0))).over(upto)
    return (
        each.withColumn("end", end)
        .filter(F.col("piece.part") >= F.col("shortest"))
        .select("blob", "kind", "rule_version", (F.col("end") - F.col("piece.span")).alias("start"), "end")
    )


def _quick(rule: Rule) -> str:
    """A necessary condition that one search decides: most texts end here."""
    return rule.pattern if rule.kind != "hex" else f"[0-9a-f]{{{rule.shortest}}}"


def _name(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


class Ledger:
    """The stored state below ``folder``: scanned pairs and findings, each run in files of its own.

    A run's findings count only once its pairs are written, so a run that broke off leaves nothing behind but files that
    nobody reads, and the next run scans the same pairs again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def pairs(self) -> DataFrame:
        return self._table("pairs", LEDGER)

    def findings(self) -> DataFrame:
        runs = self.pairs().select("blob", "kind", "rule_version", "run").distinct()
        return self._table("findings", FINDINGS).join(runs, ["blob", "kind", "rule_version", "run"], "left_semi")

    def unseen(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Blobs (blob, text, todo) of ``versions`` with a rule version that was not scanned on them."""
        blobs = versions.groupBy("blob").agg(F.any_value("text").alias("text"))
        done = self.pairs().groupBy("blob").agg(
            F.collect_set(F.concat_ws("@", "kind", F.col("rule_version").cast("string"))).alias("done")
        )
        wanted = F.array(*[F.lit(_name(r)) for r in rules])
        joined = blobs.join(done, "blob", "left")
        todo = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
        return joined.select("blob", "text", todo.alias("todo")).filter(F.size("todo") > 0)

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new in ``versions`` (blob, text) and commit it."""
        run = uuid.uuid4().hex
        pending = self.unseen(versions, rules)
        scan_blobs(pending, rules).withColumn("run", F.lit(run)).write.mode("append").parquet(f"{self.folder}/findings")
        pairs = self.unseen(versions.select("blob", F.lit("").alias("text")), rules)
        pairs = pairs.select("blob", F.explode("todo").alias("name")).select(
            "blob",
            F.split_part("name", F.lit("@"), F.lit(1)).alias("kind"),
            F.split_part("name", F.lit("@"), F.lit(2)).cast("int").alias("rule_version"),
            F.lit(run).alias("run"),
        )
        pairs.write.mode("append").parquet(f"{self.folder}/pairs")


def versions_of(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob, text) of all versions; a null text is the empty blob."""
    body = whole_text(text)
    return docs.select(F.col(path).alias("path"), F.sha2(body.cast("binary"), 256).alias("blob"), body.alias("text"))


def scan_versions(docs: DataFrame, folder: str, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES):
    """Bring the ledger in ``folder`` up to date with ``docs`` and return one row per version: path, blob, findings.

    findings: array of (start, kind, end) by start, then by the order of ``rules``; code points, end exclusive. Only current
    rule versions count. Null texts are empty, null paths and repeated rows keep their rows; an empty table gives an empty
    result, and no other column is read.
    """
    ledger = Ledger(docs.sparkSession, folder)
    versions = versions_of(docs, path, text)
    ledger.scan(versions.select("blob", "text"), rules)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("rule_version") == r.version))
    spans = (
        ledger.findings()
        .filter(current)
        .select("blob", "kind", "start", "end")
        .distinct()
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("start", order[F.col("kind")].alias("order"), "kind", "end"))).alias("found"))
    )
    found = F.transform(
        F.coalesce("found", F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>")),
        lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")),
    )
    return versions.select("path", "blob").join(spans, "blob", "left").select("path", "blob", found.alias("findings"))


def spans_text(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
