"""Near-duplicate groups with ProbMinHash signatures.

Words are normalised (A-Z lower-cased, only ASCII letters, digits and non-ASCII characters
count), five consecutive words are a shingle (all words of a shorter text), and a shingle weighs
1 + ln(occurrences).  ProbMinHash: each shingle is a Poisson process whose rate is its weight;
each arrival falls on a random register, and a register keeps the shingle that arrives first.  A
shingle stops as soon as its next arrival is later than every register's.  Two texts agree in a
register with the probability Jaccard of their weighted shingles.  That falls far below the
Jaccard of the distinct shingles where one text repeats a passage, so a text with repeated shingles
also has the bands of its distinct shingles, all of weight 1 (in other texts both are the same).

Registers are banded.  Documents of one bucket are never paired with each other: all are held
against one pivot of the bucket, the member with most company over all bands.  What is left
apart in a bucket meets further pivots, some in each round, until a round finds no new link.  The
members of buckets that are split even then meet by their rarest shingles, which leaves out no
pair of the threshold.  Every link is verified: Jaccard of the distinct shingles of at least
``threshold``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.llm import base, bytewords

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """With 25 bands of 5 a pair of similarity 0.8 is missed by all bands once in 20,000 times.

    Every text has the bands of its distinct shingles, so this holds for the similarity that is
    verified, whatever is repeated.
    """

    shingle: int = 5
    threshold: float = 0.8
    bands: int = 25
    rows: int = 5
    #: Pivots of a bucket in each later round, from inside and from outside its largest label.
    pivots: int = 4


#: Registers are a power of two, so that low bits of a random number choose one.
REGISTERS = 128

_WORDS = np.array([c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)


def shingles(buf: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, distinct shingles and how often each occurs."""
    words = bytewords.word_hashes(_WORDS[buf])
    if not len(words):
        return words, words, np.zeros(0, np.int64)
    found, counts = np.unique(bytewords.windows(words, min(n, len(words))), return_counts=True)
    return words, found, counts


def prob_minhash(elements: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The element that arrives first in each register."""
    best = np.full(registers, np.inf)
    kept = np.zeros(registers, _U)
    alive, rate, clock, drawn = elements, weights, np.zeros(len(elements)), 0
    while len(alive):
        # about as many arrivals as fill all registers, or one of each element
        draws = max(1, math.ceil(registers * (math.log(registers) + 1) / len(alive))) if drawn == 0 else 2
        with np.errstate(over="ignore"):
            steps = np.arange(drawn + 1, drawn + draws + 1, dtype=_U) * bytewords.GOLDEN
            bits = bytewords.mix(alive[:, None] ^ bytewords.mix(steps)[None, :])
        gaps = -np.log(((bits >> _U(11)).astype(np.float64) + 1) * 2.0**-53)
        times = clock[:, None] + np.cumsum(gaps, axis=1) / rate[:, None]
        where = (bits & _U(registers - 1)).astype(np.int64)
        early = times < best[where]
        t, w = times[early], where[early]
        np.minimum.at(best, w, t)
        won = t == best[w]
        kept[w[won]] = np.broadcast_to(alive[:, None], times.shape)[early][won]
        clock, drawn = times[:, -1], drawn + draws
        going = clock < best.max()
        alive, rate, clock = alive[going], rate[going], clock[going]
    return kept


def weights_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = bytewords.mix(np.arange(bands, dtype=_U))
        for column in signature[: bands * rows].reshape(bands, rows).T:
            out = bytewords.mix(out * _U(bytewords.RADIX) + column)
    return out.view(np.int64)


def all_bands(found: np.ndarray, counts: np.ndarray, settings: Settings) -> np.ndarray:
    """Band keys of the distinct shingles, and of the weighted ones where a shingle is repeated."""
    if not len(found):
        return np.zeros(0, np.int64)
    weights = [np.ones(len(found))] + [weights_of(counts)] * bool(counts.max() > 1)
    return np.unique(np.concatenate([band_keys(prob_minhash(found, w), settings.bands, settings.rows) for w in weights]))


_FEATURES = "digest binary, n_shingles int, bands array<long>, shingles array<int>"


def _features(settings: Settings):
    def run(texts: pa.Array) -> pa.Array:
        digests, sizes, bands, sets = [], [], [], []
        for buf in base.byte_rows(texts):
            words, found, counts = shingles(buf, settings.shingle)
            digests.append(blake2b(words.tobytes(), digest_size=16).digest())
            sizes.append(len(found))
            bands.append(all_bands(found, counts, settings))
            sets.append(np.unique((found >> _U(32)).astype(np.uint32)).view(np.int32))
        return base.struct(
            digest=pa.array(digests, pa.binary()), n_shingles=pa.array(sizes, pa.int32()),
            bands=_lists(bands, pa.int64()), shingles=_lists(sets, pa.int32()),
        )

    return run


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``links`` (a, b): equal labels where a path joins them.

    Least labels spread along links and jump to their own label's label; each round is one
    written table, and only the count of labels that moved reaches the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = base.written(both.distinct(), "links")
    labels = base.written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels["node"] == near["a"], "left").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        spread = spread.alias("x").join(labels.alias("y"), F.col("x.label") == F.col("y.node"), "left")
        seen = Observation()
        spread = spread.select("x.node", F.least("x.label", "y.label").alias("label"), "x.old").observe(seen, F.count_if(F.col("label") != F.col("old")).alias("moved"))
        labels = base.written(spread.drop("old"), "labels")
        if not seen.get["moved"]:
            return labels


#: Bits of a sieve: 2 MB, whatever the number of rows.
SIEVE_BITS = 24


def _sieve_words(wanted: DataFrame) -> DataFrame:
    slot = F.pmod(F.xxhash64("node"), F.lit(1 << SIEVE_BITS))
    bit = F.expr("shiftleft(1L, cast(slot & 63 AS INT))")
    return wanted.select(slot.alias("slot")).select(F.shiftright("slot", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _sifted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose node is not among ``wanted``; a join sorts out the rest.

    One bit for each slot of a hash, so the sieve has one size; the more rows are wanted, the more others
    it lets through, up to all.
    """
    found = _sieve_words(wanted).toArrow()  # at most 2 ** (SIEVE_BITS - 6) words
    bits = np.zeros(1 << SIEVE_BITS - 6, np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def passes(slots: pa.Array) -> pa.Array:
        slot = slots.to_numpy()
        return pa.array(shared.value[slot >> 6] >> (slot & 63) & 1 == 1)

    return rows.filter(F.arrow_udf(passes, "boolean")(F.pmod(F.xxhash64("node"), F.lit(1 << SIEVE_BITS))))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose distinct shingles have a Jaccard similarity of at least ``threshold``."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    with_left = pairs.join(left, "a")
    # sizes alone can rule a pair out
    both = with_left.join(right, "b").filter(F.least(F.size("x"), F.size("y")) >= threshold * F.greatest(F.size("x"), F.size("y")))
    return both.withColumn("common", common).filter(F.col("common") >= threshold * (F.size("x") + F.size("y") - F.col("common")) - 1e-9).select("a", "b")


#: Shingles are counted in 2 ** SLOT_BITS slots, so that their order is a table of fixed size.
SLOT_BITS = 20


def _slots(shingles: np.ndarray) -> np.ndarray:
    return shingles >> np.uint32(32 - SLOT_BITS)


def _slot_counts(batches):
    total = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in batches:
        total += np.bincount(_slots(batch.column("shingles").flatten().to_numpy().view(np.uint32)), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["slot", "n"])


def _prefixes(counts, threshold: float):
    """The rarest shingles of each set, as many as two sets of ``threshold`` cannot both hold without a common one."""

    def run(sets: pa.Array) -> pa.Array:
        out = []
        for row in sets:
            found = row.values.to_numpy().view(np.uint32)
            order = np.argsort(counts.value[_slots(found)] << 32 | found)
            out.append(found[order[: len(found) - math.ceil(threshold * len(found) - 1e-9) + 1]].view(np.int32))
        return _lists(out, pa.int32())

    return run


def _rare_pairs(sets: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different labels: every pair of ``sets`` of at least ``threshold`` is one of them.

    Shingles are ordered by how many sets hold their slot, then by their hash.  Two sets of the
    threshold share one of their first shingles, and at the first that they share enough shingles
    must still follow in both.  A shingle of one label makes no pair; in the others the members of
    all labels but the largest meet all of another label.
    """
    spark = sets.sparkSession
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    found = sets.select("shingles").mapInArrow(_slot_counts, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most the slots
    counts[found["slot"].to_numpy()] = np.minimum(found["n"].to_numpy(), 2**31 - 1)
    first = F.arrow_udf(_prefixes(spark.sparkContext.broadcast(counts), threshold), "array<int>")
    rows = sets.select("node", F.size("shingles").alias("size"), first(F.col("shingles")).alias("first")).join(labels, "node")
    rows = base.written(rows.select("node", "label", "size", F.posexplode("first").alias("at", "shingle")).select("node", "label", "size", (F.col("size") - F.col("at")).alias("rest"), "shingle"), "rarest")
    by_label = rows.groupBy("shingle", "label").agg(F.count("*").alias("n"))
    shared = by_label.groupBy("shingle").agg(F.count("*").alias("labels"), F.max(F.struct("n", "label"))["label"].alias("main")).filter("labels > 1")
    rows = base.written(rows.join(shared.select("shingle", "main"), "shingle"), "rarest-shared")
    x, y = rows.filter("label <> main").alias("x"), rows.alias("y")
    enough = F.least("x.rest", "y.rest") >= threshold / (1 + threshold) * (F.col("x.size") + F.col("y.size")) - 1e-9
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.label") != F.col("y.label")) & enough)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """Written: doc_id, mark of the text, row number, digest of the words, bands, distinct shingles."""
    udf = F.arrow_udf(_features(settings), _FEATURES)
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row_id"), udf(F.col("text")).alias("f"))
    with base.batches_of(docs.sparkSession, base.TEXTS_PER_BATCH):
        return base.written(rows.select("doc_id", "mark", "row_id", "f.*"), "signatures")


def _labels(rows: DataFrame, settings: Settings) -> DataFrame | None:
    """(digest, label) of the texts that are linked to a different text; None without any.

    A text goes by the least row number that has it, half as long as a digest; a label is such a number.
    """
    spark = rows.sparkSession
    # one row for each different text; a hot group of copies is one row of each task before the shuffle
    texts = rows.filter("n_shingles > 0").groupBy("digest").agg(F.min(F.struct("row_id", "bands")).alias("r"))
    texts = base.written(texts.select(F.col("r.row_id").alias("node"), "digest", "r.bands"), "texts")
    bands = texts.select("node", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members, n_members = base.counted(bands.join(shared, "key"), "members")
    if not n_members:
        return None
    company = base.written(members.groupBy("node").agg(F.sum("n").alias("company")), "company")
    members = base.written(members.join(company, "node"), "members")
    # Most texts share no band: what moves is about the sets of those that do, and they move once, to where
    # all rounds send their pairs.  What an executor loses is read from the signatures again.
    sets = _sifted(rows.select(F.col("row_id").alias("node"), "shingles"), company)
    sets = sets.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "node").join(company.select("node"), "node").persist(StorageLevel.DISK_ONLY)

    labels = company.select("node", F.col("node").alias("label"))
    hubs = members.groupBy("key").agg(F.max(F.struct("company", "node"))["node"].alias("pivot"))
    tried = base.written(hubs, "pivots")
    pairs = members.join(tried, "key").filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        ends = links.join(labels.withColumnsRenamed({"node": "a", "label": "la"}), "a").join(labels.withColumnsRenamed({"node": "b", "label": "lb"}), "b")
        moved = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")).filter("a <> b"))
        moved = moved.withColumnsRenamed({"node": "was", "label": "now"})
        labels = labels.join(moved, labels["label"] == moved["was"], "left").select("node", F.coalesce("now", "label").alias("label"))
        return base.written(labels, "labels")

    now = members.filter("n > 2")
    while True:
        links, n_links = base.counted(_verified(pairs, sets, settings.threshold), "verified")
        if not n_links:
            break
        labels = joined(labels, links)
        # Buckets of more than two texts that are still apart.  Their members outside the largest
        # label meet more pivots, the untried ones with most company inside it and outside it.
        now = members.filter("n > 2").join(labels, "node")
        split = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.struct("company", "label"))["label"].alias("main")).filter("low <> high")
        now = base.written(now.join(split.select("key", "main"), "key").withColumn("apart", F.col("label") != F.col("main")), "split")
        fresh = now.join(tried, (now["key"] == tried["key"]) & (now["node"] == tried["pivot"]), "left_anti")
        most = W.partitionBy("key", "apart").orderBy(F.desc("company"), F.desc("node"))
        turn = fresh.withColumn("rank", F.row_number().over(most)).filter(F.col("rank") <= settings.pivots)
        turn = base.written(turn.select("key", F.col("node").alias("pivot"), F.col("label").alias("own")), "pivots")
        tried = base.written(tried.union(turn.select("key", "pivot")), "tried")
        open_ = now.filter("apart").select("key", "node", "label")
        pairs = open_.join(turn, "key").filter("label <> own").select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct()
    # what shares a split bucket may not have met: all of it does by its rarest shingles
    left, n_left = base.counted(now.select("node").distinct(), "left")
    if n_left:
        apart = base.written(sets.join(left, "node"), "left-shingles")
        links, n_links = base.counted(_verified(_rare_pairs(apart, labels, settings.threshold), apart, settings.threshold), "verified")
        labels = joined(labels, links) if n_links else labels
    sets.unpersist()
    return labels.join(texts.select("node", "digest"), "node").select("digest", "label")


def _classed(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` with ``class``; a text without words is a class of its own."""
    labels = _labels(rows, settings)
    number = lambda c: F.concat(F.lit("row "), F.col(c).cast("string")).cast("binary")
    of_text = F.col("digest")
    if labels is not None:
        rows = rows.join(labels, "digest", "left")
        of_text = F.coalesce(number("label"), of_text)
    return rows.withColumn("class", F.when(F.col("n_shingles") > 0, of_text).otherwise(number("row_id")))


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_shingles.

    ``class_id`` is the least doc_id of the group (null if the group has none).  Texts of the
    same words are one group; a null or empty text, or one without a word, is a group of its own.
    Each of several rows of the same id is a row of the result.  No documents, no rows.
    """
    rows = _classed(signatures(docs, settings), settings)
    slim = base.written(rows.select("doc_id", "class", "n_shingles"), "classes")
    # written, so that the join has plain exchanges below it and a hot class can be split between tasks
    heads = base.written(slim.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "heads")
    return slim.join(heads, "class").select("doc_id", "class_id", "class_size", "n_shingles")


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents without the others of their group: the one of least id stays (null last).

    Of several rows of that id and text one stays; if their other columns differ, it may be any of
    them.  Null and empty texts, and texts without a word, are groups of their own and all stay.
    """
    rows = _classed(signatures(docs, settings), settings)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("row_id"), F.col("mark"))
    stay = rows.groupBy("class").agg(F.min(order).alias("s")).select(F.coalesce(F.col("s.doc_id").cast("string"), F.lit("")).alias("_key"), F.col("s.mark").alias("_mark"))
    known = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"), F.xxhash64("text").alias("_mark"))
    # rows of the same id and text are copies: one stays, on the partitioning of the join
    left = known.join(stay.distinct(), ["_key", "_mark"], "left_semi").dropDuplicates(["_key", "_mark"])
    return left.select("_doc.*")
