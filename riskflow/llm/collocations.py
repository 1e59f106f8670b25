"""Phrase collocations by partitioned mining (SON): whatever is frequent in the corpus is frequent, in proportion, in a shard.

The corpus is dealt into a few large shards. Each is mined completely, level by level: a phrase of k words is counted in a shard
only where the phrases of k - 1 words it is made of are frequent there, and it is frequent there from ``support`` times the
shard's share of the language's words. The union of what the shards find holds every phrase that reaches ``support`` in the
corpus; one more pass counts these candidates, as text, over all documents.

A shard is no task: it is counted by as many tasks as its texts need. Few shards keep the local support well above one, which is
what makes the method prune. Mining works on hashes of phrases: a collision can only add a candidate, never lose one, and
everything that is returned was counted as text. While mining, a phrase leaves its task as two longs, a key and a count. The
key's upper bits are a number of the language and shard; if two share it, the smaller of their supports holds. Tasks learn which
phrases are frequent from a bit filter of bounded size, where a stray bit only lets a phrase through that the counts then drop.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm import chunks, wordhash
from riskflow.llm.frames import stored, whole_text

SUPPORT, LONGEST, TOP, SHARDS = 10, 3, 2000, 2
NO_LANG = "und"
#: Percent of a candidate's occurrences inside one longer candidate from which it is dropped.
COVERED = 50
#: Bits of a filter, at least, at most, and for each key, which sets two; the filter is sent to all tasks.
FILTER_BITS, MOST_BITS, KEY_BITS = 1 << 26, 1 << 29, 16
#: Bits of a key that are the phrase's hash; those above are its language and shard.
HASH_BITS = 48

#: What ends a piece of text, and what parts its words.
BREAK = np.zeros(256, bool)
BREAK[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = True
PART = BREAK.copy()
PART[[0x20, 0x09]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _number(name: str, salt: int = 0) -> np.uint64:
    return np.uint64(int.from_bytes(blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "little"))


class Slice:
    """Texts of a slice as words: hashes, where pieces end, and the text each word is in."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data = _FOLD[data]
        found = wordhash.words(self.data, bounds, fold=False, blank=PART)
        self.starts, self.ends, self.hashes = found.starts, found.ends, found.hashes
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(found.bounds))
        breaks = np.cumsum(BREAK[self.data], dtype=np.int64)
        piece = breaks[self.starts] if len(self.starts) else np.zeros(0, np.int64)
        self.follows = (self.text[1:] == self.text[:-1]) & (piece[1:] == piece[:-1])

    def phrases(self, k: int) -> np.ndarray:
        """Words that begin a phrase of ``k`` words."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        whole = np.ones(n, bool)
        for j in range(k - 1):
            whole &= self.follows[j : j + n]
        return np.flatnonzero(whole)

    def keys(self, at: np.ndarray, k: int, lang: np.ndarray) -> np.ndarray:
        """Hashes of the phrases of ``k`` words that begin at ``at``; ``lang``: a number per text."""
        long = wordhash.mix(wordhash.chain([self.hashes[at + j] for j in range(k)], k) ^ lang[self.text[at]])
        return long & np.uint64((1 << HASH_BITS) - 1)

    def words(self) -> pa.Array:
        return chunks.strings(self.data, self.starts, self.ends)


class Filter:
    """Which hashes are set, in a bit table sent to all tasks."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, len(bits) * 64

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = self._set(keys)
        out[out] = self._set(keys[out] >> np.uint64(32))
        return out

    def _set(self, keys: np.ndarray) -> np.ndarray:
        place = keys & np.uint64(self.size - 1)
        return (self.bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def sent_filter(keys: DataFrame, most: int = MOST_BITS):
    """A broadcast Filter of the longs in the only column of ``keys``, which grows with them up to ``most`` bits. Words of the table
    with any bit go through the driver: at most ``most`` / 64 rows, whatever the number of keys; as Arrow, 16 bytes each, where
    Python rows would take some 300."""
    spark, key = keys.sparkSession, F.col(keys.columns[0])
    bits = min(most, max(FILTER_BITS, 1 << (KEY_BITS * keys.count()).bit_length()))
    places = keys.select(F.explode(F.array(key, F.shiftrightunsigned(key, 32))).alias("place"))
    places = places.select(F.col("place").bitwiseAND(F.lit(bits - 1)).alias("place"))
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    rows = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    for part in rows.to_batches():
        table[part.column(0).to_numpy()] = part.column(1).to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(table)


def _dealt(docs: DataFrame, text: str, lang: str, key: str, shards: int) -> DataFrame:
    """(lang, shard, text): a function of the row, so a recomputed task deals alike. Rows that share key and length go together;
    the shards' real sizes decide their support."""
    body = whole_text(text)
    shard = F.pmod(F.xxhash64(F.col(key), F.length(body)), F.lit(shards)).cast("int")
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), shard.alias("shard"), body.alias("text"))


#: Phrases of which a task gathers keys before it counts them, words of which it gathers text, and rows it sends at once.
GATHERED, SPELT, SENT = 1_000_000, 1_000_000, 65_536


def _sent(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for low in range(0, rows.num_rows, SENT):
        yield rows.slice(low, SENT)


class Batch:
    """Rows of a batch, taken in slices of bounded size; languages by number."""

    def __init__(self, batch: pa.RecordBatch):
        names = batch.schema.names
        self.text = batch.column(names.index("text"))
        self.shard = batch.column(names.index("shard")).to_numpy().astype(np.int64)
        coded = batch.column(names.index("lang")).dictionary_encode()
        self.langs, self.lang = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.numbers = np.array([_number(x) for x in self.langs.to_pylist()], np.uint64)

    def slices(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Slice]]:
        """(language's place, language's hash, shard) of each text, and their words."""
        for first, after, data, bounds in wordhash.slices(self.text, wordhash.SLICE_BYTES // 2):
            lang = self.lang[first:after]
            yield lang, self.numbers[lang], self.shard[first:after], Slice(data, bounds)


def _groups(lang: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """What the keys of a language (its hash) in a shard have above the phrase's hash."""
    mixed = wordhash.mix(lang + (shard.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return mixed >> np.uint64(HASH_BITS) << np.uint64(HASH_BITS)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    heads = np.flatnonzero(new)
    return heads, np.diff(heads, append=len(ordered))


def _count_phrases(k: int, below):
    """(key, n) of phrases of ``k`` words whose first and last k - 1 words are frequent in the shard. ``below``: the filter of
    those. None counts every word, as (lang, shard, key, n): lang and shard are null but in rows that hold how many words a
    language has in a shard, with a key that has no hash."""

    def phrases(part: Slice, numbers: np.ndarray, groups: np.ndarray, known: Filter | None) -> np.ndarray:
        at = part.phrases(k)
        if known is None:
            return at
        shorter = part.phrases(k - 1)
        frequent = np.zeros(len(part.starts), bool)
        frequent[shorter] = known.has(wordhash.mix(part.keys(shorter, k - 1, numbers) | groups[part.text[shorter]]))
        return at[frequent[at] & frequent[at + 1]]

    def rows(parts: list[np.ndarray]) -> pa.RecordBatch:
        ordered = np.concatenate(parts)
        ordered.sort()
        heads, n = _runs(ordered)
        key, n = pa.array(ordered[heads].view(np.int64)), pa.array(n)
        if below is not None:
            return pa.RecordBatch.from_arrays([key, n], names=["key", "n"])
        none = [pa.nulls(len(n), pa.string()), pa.nulls(len(n), pa.int32())]
        return pa.RecordBatch.from_arrays([*none, key, n], names=["lang", "shard", "key", "n"])

    def sizes(batch: Batch, own: np.ndarray) -> pa.RecordBatch:
        """``own``: number of words of each row of the batch."""
        place, row = np.unique(batch.lang << 32 | batch.shard, return_inverse=True)
        total = np.zeros(len(place), np.int64)
        np.add.at(total, row, own)
        place, total = place[total > 0], total[total > 0]
        lang, shard = place >> 32, place & 0xFFFFFFFF
        key = _groups(batch.numbers[lang], shard).view(np.int64)
        columns = [batch.langs.take(pa.array(lang)).cast(pa.string()), pa.array(shard.astype(np.int32)), pa.array(key), pa.array(total)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "shard", "key", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(below.value) if below is not None else None
        parts, held = [], 0
        for batch in map(Batch, batches):
            own = []
            for _, numbers, shard, part in batch.slices():
                groups = _groups(numbers, shard)
                at = phrases(part, numbers, groups, known)
                parts.append(part.keys(at, k, numbers) | groups[part.text[at]])
                own.append(np.bincount(part.text, minlength=len(shard)))
                held += len(at)
                if held > GATHERED:
                    yield from _sent(rows(parts))
                    parts, held = [], 0
            if known is None and own:
                yield from _sent(sizes(batch, np.concatenate(own)))
        if parts:
            yield from _sent(rows(parts))

    return count


def _joined(code: np.ndarray, top: int, more: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """(one number for each pair of numbers below ``top`` and ``size``, what they are below)."""
    if top * size >= 1 << 63:
        values, code = np.unique(code, return_inverse=True)
        top = len(values)
    return code * size + more, top * size


def _count_candidates(longest: int, wanted):
    """(lang, phrase, n) of the candidates of 1 .. ``longest`` words, as text. Words are numbered by their text, phrases counted by
    the numbers of their words, and only what is sent is spelt out."""

    def rows(batch: Batch, words: list[pa.Array], lang: np.ndarray, places: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        coded = pa.chunked_array(words).combine_chunks().dictionary_encode()
        word, spelt, space = coded.indices.to_numpy().astype(np.int64), coded.dictionary, pa.scalar(" ", pa.large_string())
        for k, parts in enumerate(places, 1):
            at = np.concatenate(parts)
            code, top = lang[at], len(batch.langs)
            for j in range(k):
                code, top = _joined(code, top, word[at + j], len(spelt))
            order = np.argsort(code)
            heads, n = _runs(code[order])
            at = at[order[heads]]
            each = [spelt.take(pa.array(word[at + j])) for j in range(k)]
            phrase = pc.binary_join_element_wise(*each, space) if k > 1 else each[0]
            columns = [batch.langs.take(pa.array(lang[at])).cast(pa.string()), phrase.cast(pa.string()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(wanted.value)
        for batch in map(Batch, batches):
            words, langs, places, held = [], [], [[] for _ in range(longest)], 0
            for lang, numbers, _, part in batch.slices():
                for k in range(1, longest + 1):
                    at = part.phrases(k)
                    places[k - 1].append(at[known.has(wordhash.mix(part.keys(at, k, numbers)))] + held)
                words.append(part.words())
                langs.append(lang[part.text])
                held += len(part.starts)
                if held > SPELT:
                    for counted in rows(batch, words, np.concatenate(langs), places):
                        yield from _sent(counted)
                    words, langs, places, held = [], [], [[] for _ in range(longest)], 0
            if words:
                for counted in rows(batch, words, np.concatenate(langs), places):
                    yield from _sent(counted)

    return count


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys as filters hold them, random in all their bits."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(wordhash.mix(batch.column(0).to_numpy().view(np.uint64)).view(np.int64))], names=["key"])


def candidates(docs: DataFrame, text: str, lang: str, key: str, support: int, longest: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n, and per word its count) and (lang, phrase, words, a): exact counts of every phrase of 1 and of 2 .. ``longest``
    words with at least ``support`` occurrences in its language."""
    dealt = _dealt(docs, text, lang, key, shards)

    def counts(k: int, below) -> DataFrame:
        by = ["key"] if k > 1 else ["lang", "shard", "key"]
        rows = dealt.mapInArrow(_count_phrases(k, below), ("" if k > 1 else "lang string, shard int, ") + "key long, n long")
        return rows.groupBy(*by).agg(F.sum("n").alias("n"))

    def sent(frequent: DataFrame):
        return sent_filter(frequent.mapInArrow(_mixed, "key long"))

    group = F.shiftrightunsigned("key", HASH_BITS).alias("group")
    local = stored(counts(1, None), "words")
    sizes = local.where("lang IS NOT NULL").select("lang", group, F.col("n").alias("own"))
    totals = stored(sizes.groupBy("lang").agg(F.sum("own").alias("total")), "totals")
    # ceil(support * own / total), in whole numbers
    need = F.expr(f"(CAST({support} AS DECIMAL(20, 0)) * own + total - 1) div total")
    needs = sizes.join(totals, "lang").select("group", F.greatest(need, F.lit(1)).alias("need"))
    needs = stored(needs.groupBy("group").agg(F.min("need").alias("need")), "needs")
    frequent = lambda df: df.select("key", "n", group).join(needs, "group").where("n >= need").select("key")
    found = [stored(frequent(local.where("lang IS NULL")), "frequent-1")]
    for k in range(2, longest + 1):
        found.append(stored(frequent(counts(k, sent(found[-1]))), f"frequent-{k}"))
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    union = union.select(F.col("key").bitwiseAND(F.lit((1 << HASH_BITS) - 1)).alias("key"))
    spelt = dealt.mapInArrow(_count_candidates(longest, sent(union)), "lang string, phrase string, n long")
    exact = spelt.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= support)
    exact = exact.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "a")
    exact = stored(exact, "candidates")
    words = exact.where("words = 1").join(totals, "lang").select("lang", "phrase", "a", "total")
    return words, exact.where("words > 1")


def _covered(found: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, covering): the most occurrences of a longer candidate that holds the phrase."""
    words = F.split("phrase", " ")

    def parts(k: int) -> DataFrame:
        inner = F.transform(F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice(words, i, k), " "))
        return found.where(F.col("words") > k).select("lang", "a", F.explode(inner).alias("phrase"))

    every = found.select("lang", "a", "phrase").limit(0)
    for k in range(2, longest):
        every = every.unionByName(parts(k))
    return every.groupBy("lang", "phrase").agg(F.max("a").alias("covering"))


def _scores(found: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, l, r, score) of the lowest-scoring cut; ties to the cut after fewest words. Products are exact decimals:
    counts may have up to 16 digits."""
    spelt = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice(spelt, 1, k), " ").alias("left"),
            F.array_join(F.slice(spelt, k + 1, F.col("words") - k), " ").alias("right"),
        ),
    )
    each = found.select("lang", "phrase", "a", F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.*")
    sides = each.select("lang", "phrase", "a", "k", F.explode(F.create_map(F.lit("l"), F.col("left"), F.lit("r"), F.col("right"))).alias("side", "part"))
    counts = words.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    counts = counts.unionByName(found.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
    joined = sides.join(counts, ["lang", "part"])
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("f"))).alias(side)
    cut = joined.groupBy("lang", "phrase", "a", "k").agg(of("l"), of("r"))
    wide = lambda c: f"CAST({c} AS DECIMAL(16, 0))"
    score = F.expr(f"CAST({wide('a')} * {wide('a')} * CAST(1000000 AS DECIMAL(7, 0)) AS DECIMAL(38, 0)) div ({wide('l')} * {wide('r')})")
    best = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    support: int = SUPPORT,
    longest: int = LONGEST,
    top: int | None = TOP,
    shards: int = SHARDS,
) -> DataFrame:
    """Per language the ``top`` (None: all) collocations of 2 .. ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    Texts are read with A-Z as a-z; null texts are empty, a null language is ``und``. Repeated rows count each; null and repeated
    keys only decide the shard. Ties of the score go by a, then by the phrase's bytes. An empty table, or one without a phrase of
    ``support`` occurrences, gives an empty result. Other columns are not read.
    """
    words, found = candidates(docs, text, lang, key, support, longest, shards)
    kept = found.join(_covered(found, longest), ["lang", "phrase"], "left")
    kept = kept.where(F.col("covering").isNull() | (100 * F.col("covering") < COVERED * F.col("a"))).select("lang", "phrase")
    rated = _scores(found, words, longest).join(kept, ["lang", "phrase"], "left_semi")
    totals = words.groupBy("lang").agg(F.first("total").alias("n"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = rated.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
