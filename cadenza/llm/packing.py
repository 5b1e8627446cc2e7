"""Cost-balanced packing of tokenized documents into sequences of a fixed length.

The cost of a piece of n tokens is linear plus quadratic (attention) in n. Pieces go in
descending order to the sequence of the lowest cost that still has room; a piece that fits
nowhere whole is cut. Each task packs groups of bounded size out of its own documents into
sequences that are all full, and leaves less than one sequence of a group over; those rests
are packed in a second, much smaller job.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import settle, values

PIECE_SCHEMA = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Entries of the table of known words in a Python worker.
KNOWN_WORDS = 250_000


class WordTokenizer:
    """Ids of a byte-level BPE, with the ids of words seen before kept.

    A text is cut at single spaces between other characters: there the vocabulary's pattern
    always ends a token. Texts with other runs of white space, or with the text of an added
    token of the vocabulary, go to the tokenizer whole. New words of ASCII and Latin letters are encoded from the ranks of the same vocabulary, which
    takes a tenth of the time; all others by the tokenizer file.
    """

    PLAIN = re.compile("[ \\n]?[\\x21-\\x7e\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]+")
    RUNS = re.compile(r"\s\s")

    def __init__(self, tokenizer_file: str, ranks_file: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) if added else "(?!)")
        self.ranks = None
        if ranks_file:
            import base64

            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_file, "rb"))}
            self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known = _Known(self)

    def encode_word(self, word: str) -> bytes:
        if self.ranks is not None and self.PLAIN.fullmatch(word):
            return np.array(self.ranks.encode_ordinary(word), dtype="<u4").tobytes()
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.RUNS.search(text) or self.added.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        return b"".join([known[w] for w in text.replace(" ", "\0 ").split("\0")]) if "\0" not in text else self.encode_word(text)


class _Known(dict):
    def __init__(self, owner: WordTokenizer):
        super().__init__()
        self.owner = owner

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.owner.encode_word(word)
        return ids


@lru_cache(maxsize=2)
def tokenizer_of(tokenizer_file: str, ranks_file: str | None, pattern: str | None) -> WordTokenizer:
    """One tokenizer for all tasks of a Python worker."""
    return WordTokenizer(tokenizer_file, ranks_file, pattern)


def pack_group(lengths: np.ndarray, room: int, sequences: int, linear: float = 1.0, quadratic: float = 1 / 512) -> list[tuple[int, int, int, int, int]]:
    """Rows (item, start, length, sequence, offset) that fill ``sequences`` sequences of ``room`` tokens.

    Items in descending length go to the lowest-cost sequence with room for them; one that
    fits nowhere whole is cut at the room of the lowest-cost sequence that is not full, and
    its rest is queued again. What is left when all sequences are full is not returned.
    """
    cost, free = np.zeros(sequences), np.full(sequences, room, dtype=np.int64)
    out, left = [], sequences * room
    queue = [(-min(room, int(n) - s), i, s) for i, n in enumerate(lengths) for s in range(0, int(n), room)]
    heapify(queue)
    while left and queue:
        n, item, start = heappop(queue)
        n = -n
        place = int(np.where(free >= n, cost, np.inf).argmin())
        if free[place] < n:
            place = int(np.where(free > 0, cost, np.inf).argmin())
            rest = n - int(free[place])
            n -= rest
            heappush(queue, (-rest, item, start + n))
        out.append((item, start, n, place, room - int(free[place])))
        cost[place] += linear * n + quadratic * n * n
        free[place] -= n
        left -= n
    return out


class _Packer:
    """Collects pieces up to a bound of tokens, and packs them."""

    def __init__(self, room: int, group: int, last: bool):
        self.room, self.group, self.last = room, group, last
        self.sequence, self.items, self.tokens = TaskContext.get().partitionId() << 32, [], 0

    def add(self, item: tuple) -> Iterator[pa.RecordBatch]:
        """item: (id, start in the document, ids, tokens of the document)."""
        ids = item[2]
        for at in range(0, len(ids), 4 * self.room * 64):  # a very long document in parts
            part = ids[at : at + 4 * self.room * 64]
            self.items.append((item[0], item[1] + at // 4, part, item[3]))
            self.tokens += len(part) // 4
            if self.tokens >= self.group:
                yield self.pack(False)

    def pack(self, final: bool) -> pa.RecordBatch:
        lengths = np.array([len(x[2]) // 4 for x in self.items], dtype=np.int64)
        whole = self.tokens // self.room
        count = -(-self.tokens // self.room) if final and self.last else whole
        rows, used = [], [[] for _ in self.items]
        for i, start, n, sequence, offset in pack_group(lengths, self.room, count):
            doc, at, ids, total = self.items[i]
            rows.append((doc, at + start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total, self.sequence + sequence, offset, None))
            used[i].append((start, start + n))
        self.sequence += count
        kept = []
        for (doc, at, ids, total), spans in zip(self.items, used):
            end = 0
            for a, b in [*sorted(spans), (len(ids) // 4, 0)]:
                if a > end:
                    kept.append((doc, at + end, ids[4 * end : 4 * a], total))
                end = b
        self.items, self.tokens = kept, sum(len(x[2]) // 4 for x in kept)
        if final:
            rows += [(doc, at, len(ids) // 4, zlib.crc32(ids), total, None, None, ids) for doc, at, ids, total in self.items]
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        types = [pa.int64()] * 7 + [pa.binary()]
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    ranks_file: str | None = None,
    pattern: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 1,
    room: int = 2048,
    group: int = 1 << 20,
) -> DataFrame:
    """Rows (id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one for each piece.

    Every id of every document is in exactly one piece. A null or empty text is the end id
    alone. Repeated rows are packed each by itself. An empty table gives no rows. All
    sequences are full but for one in each task of the second job.
    """

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = tokenizer_of(tokenizer_file, ranks_file, pattern), _Packer(room, group, last=False)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), values(batch.column(1), 64)):
                ids = tokenizer.encode(text or "") + end
                yield from packer.add((doc, 0, ids, len(ids) // 4))
        yield packer.pack(True)

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    first = settle(rows.mapInArrow(tokenize, PIECE_SCHEMA), "packed")
    kept = first.where("sequence_id is null")
    tokens, top = first.agg(F.sum(F.when(F.col("sequence_id").isNull(), F.col("length"))), F.max("sequence_id")).first()
    # A task of the second job gets some 512 sequences' tokens; its numbers lie above all others.
    tasks, above = max(1, (tokens or 0) // (room * 512)), ((top or 0) >> 32) + 1

    def pack_rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(room, group, last=True)
        packer.sequence += above << 32
        for batch in batches:
            for row in batch.to_pylist():
                yield from packer.add((row["id"], row["start"], row["ids"], row["doc_tokens"]))
        yield packer.pack(True)

    rests = kept.repartition(tasks, "id", "start").mapInArrow(pack_rests, PIECE_SCHEMA)
    return first.where("sequence_id is not null").unionByName(rests).drop("ids")
