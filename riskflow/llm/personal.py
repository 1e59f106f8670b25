"""Personal data: base patterns, and bootstrapped contextual extraction of what they miss.

The matches of the base patterns are seeds. The words around every seed and around every other token that could be an identifier
are lexical patterns; patterns and instances form a graph. Round by round a pattern's confidence for a kind is the share of its
occurrences that known instances of the kind fill, and an unknown instance is as likely of a kind as the confident patterns it
fills make it (noisy or). Rounds are grouped sums and joins over the graph. In the end the instances beyond SURE that have the
shape of their kind are personal data wherever they occur.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.frames import extended, stored, without

KINDS = ("email", "ip", "card", "phone")
#: A pattern counts from so many known instances and so much confidence; an instance from so much score.
SUPPORT, CONFIDENT, SURE = 3, 0.7, 0.9
#: Occurrences of nothing in particular that every pattern is given.
SMOOTHING = 1.0
#: Characters beside a token that are searched for its neighbours.
REACH = 80

OCCURRENCE = "array<struct<start:bigint,end:bigint,instance:string,kind:string,shapes:array<string>,patterns:array<string>>>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# The possessive runs and the look-behind keep long runs of digits linear; they change no match.
_ip = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_token = re.compile(r"\S+")
_numeric = re.compile(r"[0-9()+./-]+")
_digit = re.compile(r"[0-9]")
EDGES = ".,;:!?()[]{}<>\"'*#$%&|"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_digit.findall(s))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ with a domain behind it and at least one local character before it, that no earlier match took."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = _domain.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _digit.search(text):
        out += [("ip", *m.span()) for m in _ip.finditer(text) if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split("."))]
        for m in _card.finditer(text):
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _phone.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def shapes(token: str) -> list[str]:
    """Kinds a token could be of, more widely than the base patterns have it."""
    n, out = len(_digits(token)), []
    if "@" in token.strip("@") or re.search(r"(?i)[\[(]at[\])]", token):
        out.append("email")
    if 4 <= n <= 12 and len(re.findall(r"[0-9]+", token)) >= 4 and not re.search(r"[A-Za-z]", token):
        out.append("ip")
    if 12 <= n <= 19 and not re.search(r"[A-Za-z]", token):
        out.append("card")
    if 7 <= n <= 15 and not re.search(r"[A-Za-z]", token):
        out.append("phone")
    return out


def _neighbour(word: str) -> str:
    return re.sub(r"[0-9]+", "0", word.strip(EDGES).lower())[:40]


def patterns(text: str, start: int, end: int) -> list[str]:
    """The two words before, and one before with one behind."""
    before = ["^", "^", *map(_neighbour, text[max(0, start - REACH) : start].split())]
    behind = [*map(_neighbour, text[end : end + REACH].split()), "$"]
    return [f"{before[-2]} {before[-1]} _", f"{before[-1]} _ {behind[0]}"]


def candidates(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens with a digit or an @ that no base match touches; tokens of digits and their punctuation go together."""
    busy = sorted((s, e) for _, s, e in taken)
    spans, numeric = [], False
    for m in _token.finditer(text):
        if "@" not in m[0] and not _digit.search(m[0]):
            numeric = False
            continue
        core = m[0].strip(EDGES.replace("(", "").replace(")", ""))
        start = m.start() + m[0].find(core)
        now = _numeric.fullmatch(core) is not None
        if now and numeric and spans and text[spans[-1][1] : start] == " ":
            spans[-1] = (spans[-1][0], start + len(core))
        else:
            spans.append((start, start + len(core)))
        numeric = now
    i = 0
    for s, e in spans:
        while i < len(busy) and busy[i][1] <= s:
            i += 1
        if e - s >= 5 and not (i < len(busy) and busy[i][0] < e):
            yield s, e


def _instance(token: str) -> str:
    return token.lower() if len(token) <= 64 else hashlib.md5(token.lower().encode()).hexdigest()


def occurrences(text: str | None) -> list[dict]:
    """Seeds (with their kind) and shaped candidates of one text, with their patterns."""
    if not text or ("@" not in text and not _digit.search(text)):
        return []
    taken, out = base_spans(text), []
    for kind, s, e in taken:
        out.append((s, e, text[s:e], kind, [kind]))
    for s, e in candidates(text, taken):
        kinds = shapes(text[s:e])
        if kinds:
            out.append((s, e, text[s:e], None, kinds))
    return [
        {"start": s, "end": e, "instance": _instance(t), "kind": k, "shapes": sh, "patterns": patterns(text, s, e)}
        for s, e, t, k, sh in out
    ]


def _scanner(text: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            kind = kind or pa.list_(
                pa.struct(
                    [("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("kind", pa.string()),
                     ("shapes", pa.list_(pa.string())), ("patterns", pa.list_(pa.string()))]
                )
            )
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = pa.array([occurrences(t) for t in column.slice(at, 256).to_pylist()], kind)
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, "_found"])

    return scan


def _graph(found: DataFrame) -> DataFrame:
    """(pattern, instance, n, kinds it was a seed of, shapes)."""
    each = found.select("instance", "kind", "shapes", F.explode("patterns").alias("pattern"))
    return each.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"))


#: Scores that differ by less count as equal.
DIGITS = 6


def discover(found: DataFrame, rounds: int | None = None) -> DataFrame:
    """(instance, kind, score) of instances that no base pattern matched. ``found``: occurrences, one per row.

    Rounds go on until no score changes (in DIGITS digits). More score never makes a pattern less sure, nor a surer pattern an
    instance, so scores only grow from round to round, and the rounds end. ``rounds`` bounds them, for tests.
    """
    edges = stored(_graph(found), "pattern-graph")
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = found.filter("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    seeds = stored(seeds, "seeds")
    shaped = found.filter("kind is null").select("instance", F.explode("shapes").alias("kind")).distinct()
    # An instance that is a seed somewhere is a base match there; elsewhere it may still be found.
    shaped = stored(shaped.join(seeds.select("instance", "kind"), ["instance", "kind"], "left_anti"), "shaped")
    scores, before = seeds, None
    while True:
        rated = (
            edges.join(scores, "instance")
            .groupBy("pattern", "kind")
            .agg(
                F.sum(F.col("n") * F.col("score")).alias("good"),
                F.sum(F.when(F.col("score") >= SURE, 1).otherwise(0)).alias("support"),
            )
            .join(totals, "pattern")
            .withColumn("confidence", F.col("good") / (F.col("total") + SMOOTHING))
            .filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENT))
        )
        filled = edges.join(rated.select("pattern", "kind", "confidence"), "pattern").join(shaped, ["instance", "kind"])
        likely = filled.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))
        likely = stored(likely, "instance-scores")
        scores = seeds.unionByName(likely)
        shown = F.xxhash64("instance", "kind", F.round("score", DIGITS))
        now = likely.agg(F.count(F.lit(1)), F.sum(shown.cast("decimal(38,0)"))).first()
        rounds = rounds and rounds - 1
        if now == before or rounds == 0:
            break
        before = now
    return likely.filter(F.col("score") >= SURE)


def find_personal(docs: DataFrame, text: str = "text", rounds: int | None = None) -> DataFrame:
    """All columns of ``docs`` (a clashing one is replaced) and ``personal``: array of (kind, start, end), code points, end
    exclusive. Base kinds are KINDS; what context found has ``_context`` behind its kind. By kind as in KINDS, then context kinds
    in the same order, then start.

    A null or empty text has none. Equal rows are searched alike, each by itself; keys are not read, so they may be null or
    repeat. An empty table gives an empty result.
    """
    base = without(docs, ["personal", "_found", "_uid"])
    scanned = base.mapInArrow(_scanner(text), extended(base, f"_found {OCCURRENCE}"))
    # Numbered and stored at once: the numbers hold from then on.
    scanned = stored(scanned.withColumn("_uid", F.monotonically_increasing_id()), "personal")
    found = scanned.select("_uid", F.explode("_found").alias("o")).select("_uid", "o.*")
    known = discover(found, rounds).select("instance", "kind")
    context = (
        found.filter("kind is null")
        .drop("kind")
        .join(known, "instance")
        .groupBy("_uid")
        .agg(F.collect_set(F.struct(F.concat("kind", F.lit("_context")).alias("kind"), "start", "end")).alias("_context"))
    )
    order = F.create_map(*[x for i, k in enumerate([*KINDS, *(f"{k}_context" for k in KINDS)]) for x in (F.lit(k), F.lit(i))])
    spans = F.concat(
        F.transform(
            F.filter("_found", lambda o: o["kind"].isNotNull()),
            lambda o: F.struct(o["kind"].alias("kind"), o["start"].alias("start"), o["end"].alias("end")),
        ),
        F.coalesce("_context", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")),
    )
    ranked = F.array_sort(
        F.transform(spans, lambda x: F.struct(order[x["kind"]].alias("o"), x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("k")))
    )
    personal = F.transform(ranked, lambda x: F.struct(x["k"].alias("kind"), x["s"].alias("start"), x["e"].alias("end")))
    return scanned.join(context, "_uid", "left").select(*base.columns, personal.alias("personal"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, text: str = "text", rounds: int | None = None) -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by its kind in brackets; overlapping spans are one, under
    the kind of the first. Null texts stay null."""
    found = find_personal(docs, text, rounds)
    spans = F.array_sort(F.transform("personal", lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("k"))))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    whole = F.col(text)

    def step(state: Column, x: Column) -> Column:
        piece = whole.substr((state["at"] + 1).cast("int"), (x["s"] - state["at"]).cast("int"))
        mark = F.concat(F.lit("["), F.upper(F.split_part(x["k"], F.lit("_"), F.lit(1))), F.lit("]"))
        return F.when(
            x["s"] >= state["at"], F.struct(F.concat(state["out"], piece, mark).alias("out"), x["e"].alias("at"))
        ).otherwise(F.struct(state["out"].alias("out"), F.greatest(state["at"], x["e"]).alias("at")))

    state = F.aggregate(spans, begin, step)
    clean = F.concat(state["out"], whole.substr((state["at"] + 1).cast("int"), F.length(whole)))
    changed = F.when((F.size("personal") > 0) & whole.isNotNull(), clean).otherwise(whole)
    return found.withColumn("_clean", changed).select(*[F.col("_clean").alias(text) if c == text else c for c in docs.columns])
