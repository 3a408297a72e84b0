"""Document fingerprints by Lempel-Ziv phrases.

A text is parsed into LZ78 phrases: from each place, the longest phrase met before plus
the next character becomes a new phrase. Texts that share long passages share the phrases
of them, so the set of phrases says how well one text would compress given the other.
Each phrase is hashed from its parent's hash and its last code point, and a signature keeps
the smallest of ``HASHES`` independent mixes of these hashes. The share of equal
coordinates of two signatures estimates the Jaccard likeness of the two phrase sets.

``fingerprint`` is the signature in hex: ``HASHES`` values of 32 bits, 8 hex digits each.
An empty text has no phrase; every coordinate is then ``ffffffff``. Equal texts have equal
fingerprints, and two empty texts a likeness of 1.

``edited`` compares every document with a variant of itself: the last quarter of its code
points replaced by the start of the next document by ascending id. Rows are range
partitioned by (id, a hash of the text, the row's position in its input), so that no id
or text, however often repeated, lands in one task; each task walks its rows in order and
only the last row of each task looks up the first row of the next non-empty task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_risk.session import stored

#: Coordinates of a signature.
HASHES = 64
#: Phrase hashes are polynomial in this base, modulo the Mersenne prime 2**61 - 1.
BASE, PRIME = 1_000_003, (1 << 61) - 1
_MASK = (1 << 64) - 1
#: Seeds of the coordinates, from a fixed generator.
_SEEDS = np.random.default_rng(20240611).integers(0, 1 << 63, HASHES, dtype=np.uint64)
#: Phrases mixed at once; their mixes stay in a core's cache.
_BLOCK = 1 << 9
#: Characters of text whose phrases are hashed together.
SLICE_CHARS = 1_000_000
#: Distances of a trie's nodes: above any code point, and odd, so that keys of one character
#: differ in the low bits that a dictionary looks at first.
_ASCII_WIDTH, _WIDTH = 131, 0x110001
EMPTY = "ffffffff" * HASHES


def _codes(text: str) -> Iterable[int]:
    return text.encode() if text.isascii() else np.frombuffer(
        text.encode("utf-32-le", "surrogatepass"), dtype="<u4").tolist()


def _parse(codes: Iterable[int], trie: dict[int, int], node: int, width: int) -> int:
    """Goes on parsing from ``node``; new phrases join ``trie``. Returns the open node.

    Nodes are multiples of ``width`` in order of appearance, the root is 0. A phrase's key is
    its parent's node plus its last code point, so ``trie`` alone tells the phrases in order.
    """
    get = trie.get
    new = (len(trie) + 1) * width
    for code in codes:
        key = node + code
        node = get(key, 0)
        if not node:
            trie[key] = new
            new += width
    return node


def _hashes(parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of the phrases 1, 2, ... from those of their parents; 0 is the root.

    Phrases of equal depth are hashed together, from the shallow to the deep.
    """
    parents = np.concatenate([[0], parents])
    depth, above = (parents > 0).astype(np.int64), parents
    while above.any():  # pointers double, so a chain of n phrases takes log n rounds
        depth += depth[above]
        above = above[above]
    found = np.zeros(len(parents), dtype=np.uint64)
    order = np.argsort(depth[1:], kind="stable") + 1
    ends = np.cumsum(np.bincount(depth[1:]))
    base, prime = np.uint64(BASE), np.uint64(PRIME)
    for lo, hi in zip([0, *ends[:-1]], ends):
        at = order[lo:hi]
        h = found[parents[at]]
        # h * BASE in two parts of 31 and 30 bits; 2**61 is 1 modulo the prime
        high, low = (h >> np.uint64(31)) * base, (h & np.uint64((1 << 31) - 1)) * base
        total = ((high >> np.uint64(30)) + ((high & np.uint64((1 << 30) - 1)) << np.uint64(31))
                 + low + codes[at - 1] + np.uint64(1))
        total = (total & prime) + (total >> np.uint64(61))
        found[at] = np.where(total >= prime, total - prime, total)
    return found[1:]


def _least(found: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """The least mixes of each run of hashes, runs of ``sizes`` one after the other."""
    least = np.full((len(sizes), HASHES), np.uint64(_MASK), dtype=np.uint64)
    ends = np.cumsum(sizes)
    run = 0
    for at in range(0, len(found), _BLOCK):
        mixed = _mix(found[at:at + _BLOCK, None] ^ _SEEDS)
        done = 0
        while done < len(mixed):
            until = min(len(mixed), int(ends[run]) - at)
            if until > done:
                np.minimum(least[run], mixed[done:until].min(axis=0), out=least[run])
                done = until
            if ends[run] <= at + done:
                run += 1
    return least


def _signatures(texts: Sequence[str], followings: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of texts and of their edits, one row each.

    An LZ78 parse is decided left to right, so both parses are one up to the cut: it is
    parsed and mixed once, and the state is copied for the two different ends.
    """
    sizes, keys, widths = [], [], []
    for text, following in zip(texts, followings):
        cut = len(text) // 4
        keep = len(text) - cut
        start, end, other_end = text[:keep], text[keep:], following[:cut]
        width = _ASCII_WIDTH if text.isascii() and other_end.isascii() else _WIDTH
        trie: dict[int, int] = {}
        node = _parse(_codes(start), trie, 0, width)
        common, other = len(trie), dict(trie)
        _parse(_codes(end), trie, node, width)
        _parse(_codes(other_end), other, node, width)
        sizes.append((common, len(trie) - common, len(other) - common))
        keys += [np.fromiter(trie, np.int64, len(trie)), np.fromiter(other, np.int64, len(other))[common:]]
        widths.append(width)
    runs = np.array(sizes, dtype=np.int64).reshape(-1, 3)
    totals = runs.sum(axis=1)
    parents, codes = np.divmod(np.concatenate(keys), np.repeat(widths, totals))
    # phrases of the edit's end stand behind those of the text's own end
    place = np.arange(len(parents)) - np.repeat(np.cumsum(totals) - totals, totals)
    common, own = np.repeat(runs[:, 0], totals), np.repeat(runs[:, 1], totals)
    parents += np.where((place >= common + own) & (parents > common), own, 0)
    parents += np.where(parents > 0, np.repeat(np.cumsum(totals) - totals, totals), 0)
    least = _least(_hashes(parents, codes.astype(np.uint64)), runs.ravel()).reshape(-1, 3, HASHES)
    return tuple((np.minimum(least[:, 0], least[:, end]) >> np.uint64(32)).astype(np.uint32) for end in (1, 2))


def phrases(text: str) -> list[int]:
    """Hashes of the LZ78 phrases of ``text``, one for each distinct phrase.

    The last phrase may repeat an earlier one; it is then not new and adds nothing.
    """
    trie: dict[int, int] = {}
    _parse(_codes(text), trie, 0, _WIDTH)
    parents, codes = np.divmod(np.fromiter(trie, np.int64, len(trie)), _WIDTH)
    return _hashes(parents, codes.astype(np.uint64)).tolist()


def _hex(signature_: np.ndarray) -> str:
    return signature_.astype(">u4").tobytes().hex()


def pairs(texts: Sequence[str], followings: Sequence[str],
          chars: int = SLICE_CHARS) -> Iterator[tuple[str, str, str]]:
    """For each text and its following one: fingerprints of the text and of its edit, the edited text between.

    Texts are parsed one by one, and hashed and mixed in slices of about ``chars`` characters.
    """
    at = 0
    while at < len(texts):
        upto, size = at + 1, len(texts[at])
        while upto < len(texts) and size + len(texts[upto]) <= chars:
            size += len(texts[upto])
            upto += 1
        own, other = _signatures(texts[at:upto], followings[at:upto])
        for i in range(upto - at):
            yield _hex(own[i]), edit(texts[at + i], followings[at + i]), _hex(other[i])
        at = upto


def pair(text: str, following: str) -> tuple[str, str, str]:
    """``pairs`` of one text."""
    return next(pairs([text], [following]))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def signature(text: str) -> np.ndarray:
    """``HASHES`` minima, each of the upper 32 bits of one mix of the phrase hashes."""
    found = np.asarray(phrases(text), dtype=np.uint64)
    return (_least(found, [len(found)])[0] >> np.uint64(32)).astype(np.uint32)


def fingerprint(text: str) -> str:
    return _hex(signature(text))


def likeness(a: str, b: str) -> float:
    """Share of equal coordinates of two fingerprints."""
    x = np.frombuffer(bytes.fromhex(a), dtype=">u4")
    y = np.frombuffer(bytes.fromhex(b), dtype=">u4")
    return float(np.mean(x == y))


def edit(text: str, following: str) -> str:
    """The last floor(n/4) code points of ``text`` replaced by as many of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


_OUT = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("doc_id", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()), T.StructField("text", T.StringType()),
])


def _row(doc_id, text: str, own: str, edited_text: str, edited_fp: str, following_fp: str) -> dict:
    return {"kind": "row", "doc_id": doc_id, "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited_text.encode()).hexdigest(), "fingerprint": own,
            "edited_fingerprint": edited_fp, "near_edited": likeness(own, edited_fp),
            "near_next": likeness(own, following_fp)}


def _frame(records: list[dict]) -> pd.DataFrame:
    """Records as a frame of the output's types, missing values as nulls."""
    columns = {}
    for field in _OUT.fields:
        values = [r.get(field.name) for r in records]
        if isinstance(field.dataType, T.StringType):
            columns[field.name] = pd.Series(values, dtype=object)
        elif isinstance(field.dataType, T.DoubleType):
            columns[field.name] = pd.Series(values, dtype="Float64")
        else:
            columns[field.name] = pd.Series(values, dtype="Int64")
    return pd.DataFrame(columns)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one task in order, two steps behind: a row is parsed with its successor's
    text, and finished with its successor's fingerprint.

    Emits the first row of the task (kind ``first``) and its last (kind ``last``) with
    their texts and fingerprints, for the rows of neighbouring tasks.
    """
    held = None  # (id, text): waits for the next text
    parsed = None  # (id, text, own, edited text, edited fingerprint): waits for the next fingerprint
    part = None
    for batch in batches:
        if batch.empty:
            continue
        out, part = [], int(batch["part"].iloc[0])
        ids, texts = list(batch["doc_id"]), list(batch["text"])
        if held is not None:
            ids, texts = [held[0], *ids], [held[1], *texts]
        for doc_id, text, (own, edited_text, edited_fp) in zip(ids, texts, pairs(texts[:-1], texts[1:])):
            if parsed is None:
                out.append({"kind": "first", "doc_id": doc_id, "fingerprint": own, "text": text, "part": part})
            else:
                out.append(_row(*parsed, own) | {"part": part})
            parsed = (doc_id, text, own, edited_text, edited_fp)
        held = (ids[-1], texts[-1])
        if out:
            yield _frame(out)
    if held is not None:
        own = fingerprint(held[1])
        out = [{"kind": "first", "doc_id": held[0], "fingerprint": own, "text": held[1]}] if parsed is None \
            else [_row(*parsed, own)]
        out.append({"kind": "last", "doc_id": held[0], "fingerprint": own, "text": held[1]})
        yield _frame([r | {"part": part} for r in out])


def _close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Finishes the last row of each task with the first row of the next task."""
    for batch in batches:
        rows = []
        for p, i, t, own, nt, nfp in zip(batch["part"], batch["doc_id"], batch["text"], batch["fingerprint"],
                                         batch["next_text"], batch["next_fingerprint"]):
            edited_text = edit(t, nt)
            rows.append(_row(i, t, own, edited_text, fingerprint(edited_text), nfp) | {"part": int(p)})
        yield _frame(rows)


def edited(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
           partitions: int | None = None) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts are empty. The order is by ascending id, null ids last; rows of equal ids by a
    hash of their text, then by their place in the input (equal rows give equal results
    whichever comes first). The last row is followed by the first. Rows are never dropped;
    an empty table gives no row.
    """
    spark = docs.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("seq")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "seq": F.monotonically_increasing_id()})
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # ids pass through Python as text, exact at any size
    walked = stored(ranged.select(F.spark_partition_id().alias("part"),
                                  F.col("doc_id").cast("string").alias("doc_id"), "text")
                    .mapInPandas(_walk, _OUT), "fingerprint-walk")
    # the next non-empty task of each, the last one followed by the first: one row per task
    firsts = walked.filter("kind = 'first'").select("part", "fingerprint", "text")
    following = firsts.select("part").withColumn(
        "next_part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                                F.min("part").over(Window.partitionBy())))
    ends = (walked.filter("kind = 'last'").select("part", "doc_id", "text", "fingerprint")
            .join(following, "part")
            .join(firsts.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"),
                                F.col("fingerprint").alias("next_fingerprint")), "next_part")
            .drop("next_part"))
    closed = ends.mapInPandas(_close, _OUT)
    return (walked.filter("kind = 'row'").unionByName(closed)
            .select(F.col("doc_id").cast("long").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    "near_edited", "near_next"))
