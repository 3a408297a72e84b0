"""Near-duplicates of whole texts by DartMinHash signatures and banded joining.

A text is the weighted set of its five-word shingles; the weight is how often one occurs, and
similarity is the weighted Jaccard similarity. Every unit of weight of every shingle is a
strip onto which darts fall in the order of their ranks, as a Poisson process drawn from the
hash of shingle and unit alone. A text sees the darts in the strips that it covers, up to a
rank that leaves about ``k ln k + 2k`` of them; each dart belongs to one of ``k`` coordinates,
and the earliest per coordinate is the signature. So two texts agree in a coordinate with the
probability of their similarity, at a cost of one step per shingle and dart.

Texts of equal signature bands meet in buckets. Nothing lists all pairs of a bucket. First,
shingles that a single one of these texts has can't be shared, which bounds the similarity to
any other: texts that can't reach the threshold leave the bucket. The rest are compared with a
leader, the text with the fewest shingles of its own; where two texts have an odd and an even
number of shingles in a hash group, one of them is not shared, and few pairs pass that bound by
accident. A pair counts only in the first bucket that it shares. Only buckets whose members then belong to
several classes are compared further, with more leaders each round, until every pair that could
still join two classes has been compared. Each comparison is of the exact shingles.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohort_risk.llm.bpe import slices
from cohort_risk.llm.words import mix, shingles, words
from cohort_risk.session import stored

#: Words of a shingle, and the similarity of near-duplicates.
SHINGLE, SIMILARITY = 5, 0.8
#: A pair at 0.8 shares no band with a probability of (1 - 0.8 ** 6) ** 40, 5 in a million.
BANDS, ROWS = 40, 6
#: Hash groups of a text's profile, a multiple of 64.
GROUPS = 1024
#: Tables between the steps are many and narrow: tasks per core that write them at least, and
#: documents for which there is one more.
WAVES, DOCUMENTS_PER_TASK = 4, 5_000
#: Characters that are hashed at a time.
SLICE = 1_500_000

_GOLD = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def elements(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of each text's shingle units, and their bounds by text.

    The second unit of a shingle has another key than the first, so that the plain Jaccard
    similarity of the keys is the weighted one of the shingles.
    """
    hashes, bounds = shingles(words(texts), size)
    for a, b in zip(bounds[:-1], bounds[1:]):
        hashes[a:b].sort()
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    first[bounds[:-1][bounds[:-1] < len(hashes)]] = True
    place = np.arange(len(hashes))
    unit = place - np.maximum.accumulate(np.where(first, place, 0))
    keys = np.where(unit == 0, hashes, mix(hashes + unit.astype(np.uint64) * np.uint64(_GOLD)))
    for i in np.unique(np.searchsorted(bounds, np.flatnonzero(unit), side="right") - 1):
        keys[bounds[i]:bounds[i + 1]].sort()
    return keys, bounds


def signatures(keys: np.ndarray, bounds: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """The earliest dart of each coordinate; one row per text that has keys."""
    weight = np.diff(bounds)
    out = np.full((len(weight), k), _ALL, np.uint64)
    reach = (k * np.log(k) + 2 * k) / np.maximum(weight, 1)
    open_texts = np.flatnonzero(weight)
    while len(open_texts):
        text = np.repeat(open_texts, weight[open_texts])
        key = np.concatenate([keys[bounds[i]:bounds[i + 1]] for i in open_texts])
        rank, throw = np.zeros(len(key)), 0
        while len(key):
            throw += 1
            dart = mix(key + np.uint64(throw * _GOLD & _ALL))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
            near = np.flatnonzero(rank <= reach[text])
            key, text, rank, dart = key[near], text[near], rank[near], dart[near]
            face = mix(dart ^ np.uint64(_GOLD))
            order = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
            np.minimum.at(out.reshape(-1), text * k + ((face >> np.uint64(32)) % np.uint64(k)).astype(np.int64),
                          order | (face & np.uint64(0xFFFFFFFF)))
        open_texts = open_texts[(out[open_texts] == _ALL).any(axis=1)]
        reach[open_texts] *= 2  # a coordinate without a dart: look further
    return out


def band_hashes(sketch: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One bucket per text and band."""
    rows = sketch.reshape(len(sketch), bands, sketch.shape[1] // bands)
    value = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), rows.shape[:2])
    for r in range(rows.shape[2]):
        value = mix(value * np.uint64(_GOLD) + rows[:, :, r])
    return value


def _sketches(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Per row: id, two digests of its shingles, number of shingles, buckets."""
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1).to_pylist(), SLICE):
                ids, at = batch.column(0).slice(at, len(texts)), at + len(texts)
                keys, bounds = elements(texts)
                some = np.diff(bounds) > 0
                sums = [np.zeros(len(texts), np.uint64) for _ in range(2)]
                for j, total in enumerate(sums):
                    if len(keys):
                        total[some] = np.add.reduceat(
                            mix(keys + np.uint64(j + 1)), bounds[:-1][some])
                buckets = band_hashes(signatures(keys, bounds))[some]
                ends = np.zeros(len(texts) + 1, np.int32)
                np.cumsum(some * BANDS, out=ends[1:])
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(mix(t).view(np.int64)) for t in sums),
                     pa.array(np.diff(bounds), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(buckets.reshape(-1).view(np.int64)))],
                    ["id", "digest", "check", "n", "buckets"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"id {kind}, digest bigint, check bigint, n bigint, buckets array<bigint>")


def _profiles(texts: DataFrame) -> DataFrame:
    """Per id, the keys of its shingles and a bit per hash group: whether it has an odd number."""
    def run(batches):
        for batch in batches:
            at = 0
            for part in slices(batch.column(1).to_pylist(), SLICE):
                ids, at = batch.column(0).slice(at, len(part)), at + len(part)
                keys, bounds = elements(part)
                text = np.repeat(np.arange(len(part)), np.diff(bounds))
                group = text * GROUPS + (keys >> np.uint64(32)).astype(np.int64) % GROUPS
                profile = np.zeros(len(part) * GROUPS // 64, np.uint64)
                np.bitwise_xor.at(profile, group // 64, np.uint64(1) << (group % 64).astype(np.uint64))
                ends = np.arange(len(part) + 1, dtype=np.int32) * (GROUPS // 64)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(keys.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(profile.view(np.int64)))],
                    ["id", "keys", "profile"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, keys array<bigint>, profile array<bigint>")


def _own(profiles: DataFrame) -> DataFrame:
    """Per id, how many of its shingles no other of these texts has."""
    keys = profiles.select("id", F.explode("keys").alias("key"))
    return (keys.groupBy("key").agg(F.count(F.lit(1)).alias("texts"), F.min("id").alias("id"))
            .filter("texts = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own")))


def _apart_at_least(a: str, b: str) -> F.Column:
    """Bound on the shingles that only one of two texts has, from their profiles."""
    return reduce(lambda x, y: x + y, (
        F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(GROUPS // 64)))


def _alike(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the bound."""
    joined = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
              .select("a", "b", "text_a", "text_b"))

    def run(batches):
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep, at = [], 0
            while at < len(left):
                to, size = at, 0
                while to < len(left) and (to == at or size < SLICE):
                    size += len(left[to]) + len(right[to])
                    to += 1
                names = {t: i for i, t in enumerate(dict.fromkeys([*left[at:to], *right[at:to]]))}
                keys, bounds = elements(list(names))
                of = lambda t: keys[bounds[names[t]]:bounds[names[t] + 1]]
                for i in range(at, to):
                    a, b = of(left[i]), of(right[i])
                    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
                        continue
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if both >= similarity * (len(a) + len(b) - both) - 1e-9:
                        keep.append(i)
                at = to
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(pa.array(keep, pa.int64())) for i in (0, 1)], ["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def few_tasks(documents: DataFrame) -> int:
    """Tasks that write a narrow table about these documents: they grow with their number, and
    files of a few rows, which would outlast the work in them, are not made."""
    cores = documents.sparkSession.sparkContext.defaultParallelism
    return max(WAVES * cores, documents.count() // DOCUMENTS_PER_TASK)


def components(links: DataFrame, labels: DataFrame, tasks: int | None = None) -> DataFrame:
    """``labels`` (id, class) after all links (a, b): the smallest class that can be reached.

    Every round each row takes the smallest class among its own, its neighbours' and those
    classes' own classes; paths shrink by more than half. Each round is stored, by ``tasks`` tasks.
    """
    ends = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")),
                   F.struct(F.col("b").alias("id"), F.col("a").alias("other")))
    both = stored(links.select(F.inline(ends)), "links", tasks)
    while True:
        seen = (both.join(labels.toDF("other", "class"), "other")
                .groupBy("id").agg(F.min("class").alias("near")))
        nearer = stored(labels.join(seen, "id", "left").select(
            "id", F.least("class", F.coalesce("near", "class")).alias("class"),
            (F.col("near") < F.col("class")).alias("moved")), "classes", tasks)
        if nearer.filter("moved").isEmpty():
            return nearer.drop("moved")
        above = nearer.select(F.col("id").alias("class"), F.col("class").alias("above"))
        labels = stored(nearer.join(above, "class", "left").select(
            "id", F.coalesce("above", "class").alias("class")), "classes", tasks)


def classes(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
            similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: id, class_id, class_size, kept.

    ``class_id`` is the smallest id that can be reached over near-duplicates, and ``kept`` is
    true for its row. A text of one to four words is alike only to one of the same words; a
    text without words, or null, stands alone, as does a row without id. Ids name documents:
    rows that repeat an id share the smallest class that one of them has.
    """
    named = df.filter(F.col(id_col).isNotNull())
    rows = stored(_sketches(named, text_col, id_col), "sketches")
    tasks = few_tasks(rows)
    firsts = stored(rows.filter("n > 0").groupBy("digest", "check").agg(F.min("id").alias("first")), "copies", tasks)
    members = rows.select("id", "digest", "check", "n").join(firsts, ["digest", "check"], "left") \
        .select("id", F.coalesce("first", "id").alias("first"))
    dealt = (rows.join(firsts.select(F.col("first").alias("id")), "id", "left_semi")
             .select("id", "n", F.explode("buckets").alias("bucket")))
    shared = (dealt.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
              .filter("low < high").select("bucket"))
    met = stored(dealt.join(shared, "bucket").distinct(), "met", tasks)
    texts = stored(named.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                   .join(met.select("id").distinct(), "id", "left_semi"), "met-texts")
    part = similarity / (1 + similarity)  # of both sizes together, that the common shingles reach
    profiles = _profiles(texts)
    known = (met.join(_own(profiles), "id", "left").withColumn("own", F.coalesce("own", F.lit(0)))
             .filter((F.col("n") - F.col("own")) >= similarity * F.col("n") - 1e-9))
    least = known.groupBy("bucket").agg(F.min("n").alias("least"))
    left = stored(known.join(least, "bucket").filter(
        (F.col("n") - F.col("own")) >= part * (F.col("n") + F.greatest("least", similarity * F.col("n"))) - 1e-9)
        .drop("least"), "comparable", tasks)
    lists = left.groupBy("id").agg(F.collect_set("bucket").alias("buckets"))  # one per band at most
    left = stored(left.join(lists, "id").join(profiles.select("id", "profile"), "id"), "comparable", tasks)
    labels = stored(left.select("id", F.col("id").alias("class")).distinct(), "classes", tasks)
    leaders = 1
    while True:
        placed = left.join(labels, "id")
        several = (placed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
                   .filter("low < high").select("bucket"))
        placed = stored(placed.join(several, "bucket", "left_semi"), "open", tasks)
        if placed.isEmpty():
            break
        order = Window.partitionBy("bucket").orderBy("own", "id")
        chosen = stored(placed.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= leaders).select(
            "bucket", *(F.col(c).alias(f"{c}_a") for c in ("id", "n", "class", "profile", "buckets"))), "leaders", tasks)
        pairs = (placed.join(chosen, "bucket").filter(
            (F.col("class") != F.col("class_a")) & (F.col("id") != F.col("id_a"))
            & ((F.col("n") + F.col("n_a") - _apart_at_least("profile", "profile_a")) / 2
               >= part * (F.col("n") + F.col("n_a")) - 1e-9)
            & (F.array_min(F.array_intersect("buckets", "buckets_a")) == F.col("bucket")))
            .select(F.least("id_a", "id").alias("a"), F.greatest("id_a", "id").alias("b")).distinct())
        labels = components(_alike(pairs, texts, similarity), labels, tasks)
        left = placed.drop("class").join(
            chosen.select("bucket", F.col("id_a").alias("id")), ["bucket", "id"], "left_anti")
        leaders *= 16
    placed = stored(members.distinct().join(labels.toDF("first", "class"), "first", "left")
                    .select("id", F.coalesce("class", "first").alias("class"))
                    .groupBy("id").agg(F.min("class").alias("class")), "members", tasks)
    sizes = placed.groupBy("class").agg(F.count(F.lit(1)).alias("class_size"))
    found = placed.join(sizes, "class")
    return df.select(id_col).join(found, df[id_col] == found["id"], "left").select(
        df[id_col], F.coalesce("class", df[id_col]).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce(F.col("class") == df[id_col], F.lit(True)).alias("kept"))


def keep_one(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` that ``classes`` keeps, with their columns.

    Rows that repeat an id share its class, so the ids that go tell them apart; they are far
    fewer than those that stay.
    """
    gone = stored(classes(df, text_col, id_col, similarity).filter(~F.col("kept"))
                  .select(F.col(id_col).alias("_gone")), "near-dropped")
    return df.join(gone, df[id_col] == gone["_gone"], "left_anti")
