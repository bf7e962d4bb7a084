"""Benchmark decontamination by spaced seeds.

A seed is a run of words of which a fixed mask looks at some and ignores the
others, so a hash of the seed survives a substitution under an ignored place.
Seeds of the benchmark and of the documents are joined on their hashes; around
every hit the two texts are laid side by side and compared word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: 1: the word counts, 0: any word will do.  All look at six words.  In every 13
#: words of which 11 are equal, wherever the other two stand, one of them hits.
MASKS = ("111111", "1111011", "1110111", "1011111", "11011011", "1101100011")

#: Bits of the filter that documents are looked up in before the join: 2 MB at any size.
FILTER_BITS = 1 << 24

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class _WordHashes(dict):
    """Word -> 8 bytes of hash; remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> bytes:
        from xxhash import xxh64_digest

        found = xxh64_digest(word)
        if len(self) < 1_000_000:
            self[word] = found
        return found


_HASHES = _WordHashes()


def word_hashes(text: str):
    """A 64-bit hash per word: letters and digits, lower-cased; everything else only separates."""
    import numpy as np

    words = _WORD.findall(text.lower().encode("utf-8", "surrogatepass"))
    return np.frombuffer(b"".join(map(_HASHES.__getitem__, words)), np.uint64)


def seeds(words, mask: str, number: int):
    """The hash of every seed of the mask, by the seed's first word."""
    import numpy as np

    count = len(words) - len(mask) + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, number + 1, np.uint64)
    for i, use in enumerate(mask):
        if use == "1":
            total *= np.uint64(0x9E3779B97F4A7C15)
            total += words[i : i + count]
            total ^= total >> np.uint64(29)
    return total


def slots(hashes):
    """The two filter bits of each hash."""
    import numpy as np

    top = np.uint64(FILTER_BITS - 1)
    return hashes & top, (hashes >> np.uint64(32)) & top


def _words_of(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        words = [word_hashes(t or "").tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["item", "words"])


def whole(masks: Sequence[str], count: int) -> tuple[int, str]:
    """Number and mask of the seed that is all words of an item too short for the masks."""
    return len(masks) + count, "1" * count


def _seeds_of(batches: Iterator, masks: Sequence[str]) -> Iterator:
    import numpy as np
    import pyarrow as pa

    shortest = min(map(len, masks))
    for batch in batches:
        for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = np.frombuffer(raw, np.uint64)
            for number, mask in enumerate(masks) if len(words) >= shortest else [whole(masks, len(words))]:
                found = seeds(words, mask, number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array(found.view(np.int64)), pa.array(np.arange(len(found)))],
                    names=["item", "seed", "at"],
                )


def _filter_part(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    bits = np.zeros(FILTER_BITS, np.bool_)
    for batch in batches:
        for slot in slots(batch.column(0).to_numpy().view(np.uint64)):
            bits[slot] = True
    packed = np.packbits(bits).reshape(64, -1)
    used = np.flatnonzero(packed.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array([packed[i].tobytes() for i in used], pa.binary())], names=["block", "bits"]
    )


def _or_blocks(pdf):
    import numpy as np
    import pandas as pd

    total = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in pdf["bits"]])
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "bits": [total.tobytes()]})


def seed_filter(seed_rows: DataFrame):
    """A bitmap of `FILTER_BITS` bits with the slots of all seeds; its size does not depend on the benchmark's."""
    import numpy as np

    # One bitmap of 2 MB per task at most; tasks are few, as each reads many seeds.
    parts = seed_rows.select("seed").mapInArrow(_filter_part, "block int, bits binary")
    merged = parts.groupBy("block").applyInPandas(_or_blocks, "block int, bits binary")
    bits = np.zeros((64, FILTER_BITS // 8 // 64), np.uint8)
    for row in merged.collect():
        bits[row.block] = np.frombuffer(row.bits, np.uint8)
    return bits.tobytes()


def _find(batches: Iterator, masks: Sequence[str], short: Sequence[int], wanted) -> Iterator:
    import numpy as np
    import pyarrow as pa

    looks = [*enumerate(masks), *(whole(masks, count) for count in short)]
    known = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).view(np.bool_)
    kind = pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int64())]))
    for batch in common.partial_rows(batches, 1000):
        keep, words_out, hits_out = [], [], []
        for n, text in enumerate(batch.column(2).to_pylist()):
            words = word_hashes(text or "")
            hits: list[tuple[int, int]] = []
            for number, mask in looks:
                found = seeds(words, mask, number)
                one, two = slots(found)
                near = np.flatnonzero(known[one])
                near = near[known[two[near]]]
                hits += zip(found[near].view(np.int64).tolist(), near.tolist())
            if hits:
                keep.append(n)
                words_out.append(words.tobytes())
                hits_out.append(hits)
        if keep:
            kept = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array(words_out, pa.binary()), pa.array(hits_out, kind)],
                names=["id", "text_key", "words", "hits"],
            )


def overlaps(document, item, shift: int, window: int, similarity: float) -> list[tuple[int, int, int]]:
    """(first word, words, equal words) of the runs where `item` laid at `shift` matches the document.

    A run is a union of windows of `window` words in which at least the share
    `similarity` of the words are equal, or the whole item if it has that share.
    An item shorter than a window must be there word by word.
    """
    import math

    import numpy as np

    first, last = max(0, shift), min(len(document), shift + len(item))
    size = min(window, len(item))
    if last - first < size or size == 0:
        return []
    needed = math.ceil(similarity * size - 1e-9) if len(item) >= window else size
    same = (document[first:last] == item[first - shift : last - shift]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(same)])
    if last - first == len(item) >= window and total[-1] >= similarity * len(item) - 1e-9:
        return [(first, len(item), int(total[-1]))]
    good = np.flatnonzero(total[size:] - total[:-size] >= needed)
    found = []
    for run in np.split(good, np.flatnonzero(np.diff(good) > size) + 1) if len(good) else []:
        a, b = int(run[0]), int(run[-1]) + size
        found.append((first + a, b - a, int(total[b] - total[a])))
    return found


def _verify(batches: Iterator, window: int, similarity: float) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in common.partial_rows(batches, 200):
        rows = []
        for key, text_key, item, words, own, shifts in zip(*(batch.column(i).to_pylist() for i in range(6))):
            document, passage = np.frombuffer(words, np.uint64), np.frombuffer(own, np.uint64)
            for shift in sorted(shifts):
                rows += [(key, text_key, item, *run) for run in overlaps(document, passage, shift, window, similarity)]
        columns = list(zip(*rows)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["id", "text_key", "item", "start", "words", "equal"]
        )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: Sequence[str] = MASKS,
    window: int = 13,
    similarity: float = 0.8,
) -> DataFrame:
    """The benchmark passages in documents: `id`, `text_key`, `item`, `start`, `words`, `equal`.

    `start` and `words` are the run in the document, `equal` its words that are
    the item's; `text_key` is the text's hash, which with `id` tells the row.
    A run needs windows of `window` words, or a whole item, with the share
    `similarity` equal; an item shorter than a window must match word by word.
    With the given masks no such window is missed.  Null and empty texts have no
    words.  An item too short for the masks (under six words) is one seed of all
    its words; an item of one or two words so matches every text that has them.
    Items without words match nothing.  Repeated rows or items give repeated rows; null
    ids stay null.  An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    passages = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    passages = common.stored(
        passages.mapInArrow(_words_of, "item long, words binary").withColumn("_item", F.monotonically_increasing_id()), "items"
    )
    table = common.stored(
        passages.select("_item", "words").mapInArrow(partial(_seeds_of, masks=masks), "item long, seed long, at long"), "seeds"
    )
    # The lengths of items below the shortest mask, at most five numbers; without such items texts are not looked at for them.
    length = F.octet_length("words") / 8
    short = passages.where((length > 0) & (length < min(map(len, masks)))).select(length.cast("int").alias("n")).distinct()
    short = sorted(row.n for row in short.collect())
    wanted = spark.sparkContext.broadcast(seed_filter(table))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(common.text_or_empty(text_col)).alias("text_key"),
        F.col(text_col).cast("string").alias("text"),
    )
    flagged = rows.mapInArrow(
        partial(_find, masks=masks, short=short, wanted=wanted),
        "id long, text_key long, words binary, hits array<struct<seed:long,at:long>>",
    )
    flagged = common.stored(flagged.withColumn("_row", F.monotonically_increasing_id()), "hits")
    hits = flagged.select("_row", F.explode("hits").alias("h")).select("_row", "h.seed", F.col("h.at").alias("doc_at"))
    laid = hits.join(table, "seed").select("_row", F.col("item").alias("_item"), (F.col("doc_at") - F.col("at")).alias("shift"))
    laid = laid.distinct().groupBy("_row", "_item").agg(F.collect_list("shift").alias("shifts"))
    pairs = laid.join(flagged.drop("hits"), "_row").join(passages.withColumnRenamed("words", "own"), "_item")
    return pairs.select("id", "text_key", "item", "words", "own", "shifts").mapInArrow(
        partial(_verify, window=window, similarity=similarity),
        "id long, text_key long, item long, start long, words long, equal long",
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of `docs` without a benchmark passage, all columns as they are."""
    found = contaminated(docs, items, id_col, text_col, **params).select("id", "text_key").distinct()
    same = docs[id_col].cast("long").eqNullSafe(found["id"]) & (F.xxhash64(common.text_or_empty(text_col)) == found["text_key"])
    return docs.join(found, same, "left_anti")
