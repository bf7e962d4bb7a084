"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

Open sequences are counted by the gap they have left.  A piece goes to the gap
that makes the sum of the squared counts smallest, which keeps all gaps about
equally common and so keeps a fit for later pieces.  A sequence is opened only
when a piece fits nowhere, and pieces come by falling length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Pieces packed together in one task, about.
LOT = 32_768
#: Words whose ids a Python worker remembers; further ones are encoded each time.
REMEMBERED = 600_000
#: Below this code point a letter is a letter for every library.
_PLAIN = "\u0250"

_PIECES = "id long, piece int, start long, length long, ids_crc32 long"


class WordIds(dict):
    """Word -> bytes of the ids of a blank and the word, encoded on first use."""

    def __init__(self, encode, encode_letters, codes):
        super().__init__()
        self.encode, self.encode_letters, self.codes = encode, encode_letters, codes

    def __missing__(self, word: str) -> bytes:
        body, last = word[:-1], word[-1:]
        if word.isalpha() and max(word) < _PLAIN:
            found = self.codes(self.encode_letters(b" " + word.encode()))
        elif last in ".,;:!?" and body.isalpha() and max(body) < _PLAIN:
            # A letter run ends before punctuation, and nothing follows here.
            found = self[body] + self.codes(self.encode(last))
        else:
            found = self.codes(self.encode(" " + word))
        if len(self) < REMEMBERED:
            self[word] = found
        return found


@lru_cache(maxsize=4)
def encoder(tokenizer: str, ranks: str | None = None):
    """text -> little-endian unsigned 32-bit ids, as the `tokenizers` file gives them.

    `ranks` may name the same vocabulary as a `tiktoken` file.  Then words are
    encoded once each: a text of a byte-level tokenizer may be cut before a
    single blank, since no piece of it spans that place.  Texts with blanks
    inside longer white space, or with an added token's string, go whole
    through the tokenizer.
    """
    import base64
    import re
    from array import array

    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer)

    def codes(ids) -> bytes:
        return array("I", ids).tobytes()

    def slow(text: str) -> bytes:
        return codes(whole.encode(text, add_special_tokens=False).ids)

    if ranks is None:
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    core = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})._core_bpe
    words = WordIds(core.encode_ordinary, core.encode_single_piece, codes)
    added = [re.escape(t.content) for t in whole.get_added_tokens_decoder().values()]
    special = re.compile("|".join([r"\s \s", r"\s \Z", *added]))

    def fast(text: str) -> bytes:
        if special.search(text):
            return slow(text)
        first, *rest = text.split(" ")
        return codes(core.encode_ordinary(first)) + b"".join(map(words.__getitem__, rest))

    return fast


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, and before them a first one with what is over."""
    over = length % capacity
    starts = [(0, over)] if over else []
    return starts + [(at, capacity) for at in range(over, length, capacity)]


def _pieces(batches: Iterator, tokenizer: str, ranks: str | None, end_id: int, capacity: int) -> Iterator:
    import zlib
    from array import array

    import pyarrow as pa

    encode, end = encoder(tokenizer, ranks), array("I", [end_id]).tobytes()
    for batch in common.partial_rows(batches, 1000):
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = encode(text or "") + end
            for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                rows.append((key, n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in _PIECES.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The token pieces of every document: `id`, `piece`, `start`, `length`, `ids_crc32`."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    made = partial(_pieces, tokenizer=tokenizer, ranks=ranks, end_id=end_id, capacity=capacity)
    return rows.mapInArrow(made, _PIECES)


def place(lengths, capacity: int):
    """(sequence, offset) for lengths given in falling order; sequences are numbered from 0."""
    import numpy as np

    open_by_gap: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, np.int64)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, size in enumerate(map(int, lengths)):
        if size == capacity:
            sequence[i], offset[i] = opened, 0
            opened += 1
            continue
        there = counts[size:capacity]
        # Half the change of the sum of squares, for each gap that the piece fits.
        change = counts[: capacity - size] - there + 1
        change[0] = -there[0]
        best = int(np.where(there > 0, change, capacity * len(lengths)).argmin())
        gap = size + best
        if counts[gap]:
            number, filled = open_by_gap[gap].pop()
            counts[gap] -= 1
        else:
            number, filled, gap = opened, 0, capacity
            opened += 1
        sequence[i], offset[i] = number, filled
        if gap > size:
            open_by_gap[gap - size].append((number, filled + size))
            counts[gap - size] += 1
    return sequence, offset


def _pack_lot(pdf, capacity: int):
    rows = pdf.sort_values(["length", "id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True])
    number, offset = place(rows["length"].to_numpy(), capacity)
    return rows.drop(columns="lot").assign(sequence_id=rows["lot"].to_numpy() * (1 << 32) + number, offset=offset)


def pack(found: DataFrame, capacity: int = 2048, lot: int = LOT) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces.

    Pieces are dealt by chance into lots of about `lot` pieces, packed side by
    side in separate tasks, so the memory of a task does not grow with the
    input.  A lot wastes a few sequences at its end, well under one in a thousand.
    """
    found = common.stored(found.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    lots = -(-found.count() // lot) or 1
    dealt = found.withColumn("lot", F.pmod(F.xxhash64("_row"), F.lit(lots))).drop("_row")
    return dealt.groupBy("lot").applyInPandas(
        partial(_pack_lot, capacity=capacity), _PIECES + ", sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = 2048, **params) -> DataFrame:
    """Tokenise, cut and pack: `id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset` per piece.

    A null text is empty and gives the end id alone.  Repeated rows are packed
    each on their own; a null id stays null.  Only documents longer than a
    sequence are cut.  An empty table gives no rows.
    """
    return pack(pieces(docs, tokenizer, ranks, capacity, **params), capacity)
