"""Collocations: phrases whose words come together far more often than apart.

Stripes: each prefix keys an associative counter of the words that follow it. A task makes the
entries of its stripes from hashes, and they are merged entry by entry over the cluster, so no
stripe has to fit in one task. The merged table gives the counts of all phrases, and the greatest
entry of a prefix or of a suffix. An entry goes by 64 bits of its phrase and 32 more of its
prefix, a word by 64 bits.

A phrase can only be frequent if its first and its last words without one are. So entries are
counted level by level, and the slots of the frequent ones marked in a bitmap of fixed size. A
phrase of the next level is hashed only if both its parts fall on marks. A false mark costs a
count and changes nothing, as entries below the bound are left out after the merge.

Only frequent entries get words. Each text has a ticket, a small hash, and an entry keeps the
least ticket of the texts that hold it. The words are read from texts with that ticket alone, so
an entry is named about once and not by every task that meets it.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import hinted, settle, values

#: Ends a piece; the byte occurs in no UTF-8 text.
MARK = b"\xff"
_SIGNS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", MARK * 10 + b" ")
#: Bits of a bitmap, a power of two: 8 MB.
SLOTS = 1 << 26
#: Words that are handled at once, hashes and entries that a task holds before it passes them on.
CHUNK, HASHES, ENTRIES = 200_000, 1_500_000, 400_000
#: Words whose hashes or numbers are remembered.
KNOWN = 500_000
#: Bits of a ticket, and where they lie in a slot.
TICKET_BITS, TICKET_AT = 16, 10
_ID_BITS = 21
_MIX, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text with A-Z lower-cased, and a MARK wherever a piece ends."""
    return (text or b"").lower().translate(_SIGNS).replace(MARK, b" \xff ").split()


def _hash(lang: str, word: bytes) -> int:
    """A word's hash; 0 is the MARK's."""
    return xxhash.xxh64_intdigest(lang.encode() + MARK + word) or 1


def _mixed(mixed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The hashes of phrases, from those of all words but the last and of the last."""
    mixed = (mixed ^ hashes) * _MIX
    return mixed ^ (mixed >> np.uint64(29))


def _phrases(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each phrase of ``size`` words, from the hashes of words in a row."""
    n = max(len(hashes) - size + 1, 0)
    mixed = np.zeros(n, np.uint64)
    for i in range(size):
        mixed = _mixed(mixed, hashes[i : i + n])
    return mixed


def _checks(hashes: list[np.ndarray]) -> np.ndarray:
    """32 bits of prefixes, from the hashes of their words; prefixes of one hash in ``_phrases`` differ here."""
    total = np.zeros(len(hashes[0]), np.uint64)
    for column in hashes:
        total = (total + column) * _OTHER
    return (total >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _ticket(text: bytes | None) -> int:
    """The ticket of a text: the same wherever and whenever it is read."""
    return xxhash.xxh32_intdigest(text or b"") & ((1 << TICKET_BITS) - 1)


def _marked(phrases: np.ndarray, bitmap: np.ndarray, slots: int) -> np.ndarray:
    at = (phrases & np.uint64(slots - 1)).astype(np.int64)
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def _named_here(phrases: np.ndarray, tickets: np.ndarray, bitmap: np.ndarray, slots: int) -> np.ndarray:
    """Where both slots of a phrase and its text's ticket are marked; see ``mark_tickets``."""
    tickets = tickets.astype(np.uint64) << np.uint64(TICKET_AT)
    found = _marked(phrases ^ tickets, bitmap, slots)
    at = np.flatnonzero(found)
    found[at] = _marked((phrases[at] >> np.uint64(32)) ^ tickets[at], bitmap, slots)
    return found


def _unbroken(words: np.ndarray, size: int) -> np.ndarray:
    """Where ``size`` words lie in one piece."""
    n = max(len(words) - size + 1, 0)
    whole = np.ones(n, bool)
    for i in range(size):
        whole &= words[i : i + n] != 0
    return whole


def _stretches(batches: Iterator[pa.RecordBatch], longest: int, kept: np.ndarray | None = None) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """The words of each language and their texts' tickets, CHUNK of them and as many more as a phrase may reach beyond.

    If the bitmap of the tickets that entries keep is given, other texts are left out, as they name nothing.
    """
    waiting: dict[str, tuple[list[bytes], list[int], list[int]]] = {}

    def cut(lang: str) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        words, tickets, ends = waiting.pop(lang)
        return _cut(lang, words, longest, np.repeat(np.array(tickets, np.int32), np.diff(ends, prepend=0)))

    for batch in batches:
        for lang, text in zip(values(batch.column(0)), values(batch.column(1))):
            ticket = _ticket(text)
            if kept is not None and not kept[ticket >> 3] >> (ticket & 7) & 1:
                continue
            words, tickets, ends = waiting.setdefault(lang, ([], [], []))
            words += words_of(text)
            words.append(MARK)
            tickets.append(ticket)
            ends.append(len(words))
            if len(words) > CHUNK:
                yield from cut(lang)
    for lang in [*waiting]:
        yield from cut(lang)


def _cut(lang: str, words: list[bytes], longest: int, *beside: np.ndarray) -> Iterator[tuple]:
    for start in range(0, len(words), CHUNK):
        yield lang, *(x[start : start + CHUNK + longest - 1] for x in (words, *beside))


def _texts(docs: DataFrame, text_column: str, lang_column: str, no_lang: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(no_lang))
    return docs.select(lang.alias("lang"), F.col(text_column).cast("string").cast("binary").alias("text"))


def count_words(texts: DataFrame) -> DataFrame:
    """Rows (lang, word, f) of all words; the row of the null word has the total of its language."""

    def rows_of(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs = [lang for lang, words in counts.items() for _ in range(len(words) + 1)]
        names = [w for words in counts.values() for w in (None, *(w.decode() for w in words))]
        totals = [n for words in counts.values() for n in (words.total(), *words.values())]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(names, pa.string()), pa.array(totals, pa.int64())], ["lang", "word", "f"])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(values(batch.column(0)), values(batch.column(1))):
                counter = counts.setdefault(lang, Counter())
                counter.update(words_of(text))
                counter.pop(MARK, None)
                if len(counter) > ENTRIES // 4:
                    yield rows_of(counts)
                    counts = {}
        yield rows_of(counts)

    return texts.mapInArrow(of_batches, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


class _Hashes(dict):
    """The hashes of a language's words."""

    def __init__(self, lang: str) -> None:
        super().__init__({MARK: 0})
        self.lang = lang

    def __missing__(self, word: bytes) -> int:
        self[word] = found = _hash(self.lang, word)
        return found


def hash_words(words: DataFrame) -> DataFrame:
    """Rows (key): the hash of each word (lang, word) as a phrase of one."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_hash(lang, w.encode()) for lang, w in zip(values(batch.column(0)), values(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([pa.array(_phrases(np.array(found, np.uint64), 1).view(np.int64))], ["key"])

    return words.select("lang", "word").mapInArrow(of_batches, "key long")


def hash_phrases(texts: DataFrame, size: int, bitmap: np.ndarray, least: int, slots: int = SLOTS) -> DataFrame:
    """Rows (key, check, f, ticket) of the phrases of ``size`` words that occur ``least`` times: the
    entries of the stripes, by the hash of the phrase and bits of its prefix's."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)
    names = ["key", "check", "f", "ticket"]

    def counted(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))
        keys, checks, tickets = map(np.concatenate, zip(empty, *held))
        order = np.argsort(keys)
        keys, checks, tickets = keys[order], checks[order], tickets[order]
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1]))[: len(keys)])
        least_tickets = np.minimum.reduceat(tickets, starts) if len(starts) else tickets
        columns = [keys[starts].view(np.int64), checks[starts], np.diff(starts, append=len(keys)), least_tickets]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns)], names)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, _Hashes] = {}
        held, total = [], 0
        for lang, words, tickets in _stretches(batches, size):
            known_here = known.setdefault(lang, _Hashes(lang))
            hashes = np.fromiter(map(known_here.__getitem__, words), np.uint64, len(words))
            if sum(map(len, known.values())) > KNOWN:
                known = {}
            prefixes = _phrases(hashes, size - 1)
            marked = _marked(prefixes, shared.value, slots)
            n = max(len(hashes) - size + 1, 0)
            at = np.flatnonzero(marked[:n] & marked[1 : n + 1] & _unbroken(hashes, size))
            held.append((_mixed(prefixes[at], hashes[at + size - 1]), _checks([hashes[at + i] for i in range(size - 1)]), tickets[at]))
            total += len(at)
            if total > HASHES:
                yield counted(held)
                held, total = [], 0
        yield counted(held)

    found = texts.mapInArrow(of_batches, "key long, check int, f long, ticket int")
    return found.groupBy("key", "check").agg(F.sum("f").alias("f"), F.min("ticket").alias("ticket")).where(F.col("f") >= least)


def mark(keys: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """The bitmap of hashes: a fixed number of bytes, whatever the number of rows."""
    slot = keys.select(F.col("key").bitwiseAND(F.lit(slots - 1)).alias("slot")).select((F.col("slot") + 1).alias("slot"))
    buckets = slot.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bitmap = np.zeros(-(-slots // 32768) * 4096, np.uint8)
    for row in buckets.collect():
        at = (row["bucket"] - 1) * 4096
        bitmap[at : at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def mark_tickets(entries: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """The bitmap of entries with their tickets, two slots each."""
    ticket = F.shiftleft(F.col("ticket").cast("long"), TICKET_AT)
    both = F.array(F.col("key").bitwiseXOR(ticket), F.shiftrightunsigned("key", 32).bitwiseXOR(ticket))
    return mark(entries.select(F.explode(both).alias("key")), slots)


class _Names(dict):
    """Numbers of a language's words, given as they come; number 0 is the MARK."""

    def __init__(self, lang: str, words: list[bytes], hashes: array) -> None:
        super().__init__({MARK: 0})
        self.lang, self.words, self.hashes = lang, words, hashes

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(_hash(self.lang, word))
        return number


class _Stripes:
    """A task's stripes: for each language and length of phrase a counter of next words for each prefix."""

    def __init__(self, bitmaps: dict[int, np.ndarray], slots: int) -> None:
        self.bitmaps, self.slots = bitmaps, slots
        self.clear()

    def clear(self) -> None:
        self.words, self.hashes = [MARK], array("Q", [0])
        self.names: dict[str, _Names] = {}
        self.stripes: dict[tuple[str, int], dict[int, dict[int, int]]] = {}
        self.entries = 0

    def full(self) -> bool:
        return self.entries > ENTRIES or len(self.words) > min(KNOWN, (1 << _ID_BITS) - 2 * CHUNK - 16)

    def add(self, lang: str, words: list[bytes], tickets: np.ndarray | None = None) -> None:
        """Count the marked phrases that start in the first CHUNK words; with tickets, those named here."""
        names = self.names.setdefault(lang, _Names(lang, self.words, self.hashes))
        ids = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
        hashes = np.frombuffer(self.hashes, np.uint64)[ids]
        for size, bitmap in self.bitmaps.items():
            phrases = _phrases(hashes, size)
            if tickets is None:
                wanted = _marked(phrases, bitmap, self.slots)
            else:
                wanted = _named_here(phrases, tickets[: len(phrases)], bitmap, self.slots)
            at = np.flatnonzero((wanted & _unbroken(ids, size))[:CHUNK])
            prefix = ids[at]
            for i in range(1, size - 1):
                prefix = (prefix << _ID_BITS) | ids[at + i]
            stripes = self.stripes.setdefault((lang, size), {})
            for p, w in zip(prefix.tolist(), ids[at + size - 1].tolist()):
                stripe = stripes.get(p)
                if stripe is None:
                    stripes[p] = {w: 1}
                    self.entries += 1
                elif w in stripe:
                    stripe[w] += 1
                else:
                    stripe[w] = 1
                    self.entries += 1

    def rows(self) -> pa.RecordBatch:
        """A row for each prefix: its stripe, the bits of its hash and the hashes of the phrases, in the stripe's order."""
        langs, sizes, prefixes, ends, nexts, counts = [], [], [], [0], [], []
        checks, keys = [np.zeros(0, np.int32)], [np.zeros(0, np.uint64)]
        hashes, low = np.array(self.hashes, np.uint64), (1 << _ID_BITS) - 1
        for (lang, size), stripes in self.stripes.items():
            hashed = np.zeros(len(stripes), np.uint64)
            numbers = [[(p >> shift) & low for p in stripes] for shift in range((size - 2) * _ID_BITS, -1, -_ID_BITS)]
            columns = [hashes[np.array(column, np.int64)] for column in numbers]
            for column in columns:
                hashed = _mixed(hashed, column)
            after = np.array([w for stripe in stripes.values() for w in stripe], np.int64)
            checks.append(_checks(columns))
            keys.append(_mixed(np.repeat(hashed, [*map(len, stripes.values())]), hashes[after]))
            for words, stripe in zip(zip(*numbers), stripes.values()):
                langs.append(lang)
                sizes.append(size)
                prefixes.append(b" ".join([self.words[w] for w in words]).decode())
                nexts += [self.words[w].decode() for w in stripe]
                counts += stripe.values()
                ends.append(len(nexts))
        ends = pa.array(ends, pa.int32())
        stripe = pa.MapArray.from_arrays(ends, pa.array(nexts, pa.string()), pa.array(counts, pa.int64()))
        key = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys).view(np.int64)))
        columns = [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.string()), stripe, pa.array(np.concatenate(checks)), key]
        return pa.RecordBatch.from_arrays(columns, ["lang", "size", "prefix", "stripe", "check", "keys"])


def task_stripes(texts: DataFrame, entries: dict[int, DataFrame], slots: int = SLOTS) -> DataFrame:
    """Rows (lang, size, prefix, stripe, check, keys): the stripes in words, each entry from texts with
    its ticket; entries by the size of phrases."""
    tickets = reduce(DataFrame.unionByName, [rows.select(F.col("ticket").cast("long").alias("key")) for rows in entries.values()])
    kept = mark(tickets, 1 << TICKET_BITS)
    shared = texts.sparkSession.sparkContext.broadcast(({size: mark_tickets(rows, slots) for size, rows in entries.items()}, kept))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, kept = shared.value
        stripes = _Stripes(bitmaps, slots)
        for stretch in _stretches(batches, max(bitmaps), kept):
            stripes.add(*stretch)
            if stripes.full():
                yield stripes.rows()
                stripes.clear()
        yield stripes.rows()

    return texts.mapInArrow(of_batches, "lang string, size int, prefix string, stripe map<string, long>, check int, keys array<long>")


def count_stripes(texts: DataFrame, entries: dict[int, DataFrame], slots: int = SLOTS) -> DataFrame:
    """Rows (lang, size, prefix, next, f) of the merged entries, given by the size of phrases."""
    found = task_stripes(texts, entries, slots).select("lang", "size", "prefix", "check", "keys", F.posexplode(F.map_keys("stripe")).alias("at", "next"))
    found = found.withColumn("key", F.col("keys")[F.col("at")]).drop("keys", "at")
    counts = [rows.select(F.lit(size).alias("size"), "key", "check", "f") for size, rows in entries.items()]
    named = found.dropDuplicates(["lang", "size", "prefix", "next"]).join(reduce(DataFrame.unionByName, counts), ["size", "key", "check"])
    return named.select("lang", "size", "prefix", "next", "f")


def collocations(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = 30, longest: int = 4, top: int = 2000,
    subsumed_percent: int = 80, no_lang: str = "und", slots: int = SLOTS,
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    Words lie between spaces and tabs, pieces between ``. , ; : ! ?`` and line ends. A phrase has 2
    to ``longest`` words of one piece and occurs ``least`` times or more (a). Its score is the
    smallest floor(2000000 * a / (l + r)) over its cuts into a first part (l times) and the rest
    (r times), of equal ones that of the shortest first part. A phrase inside a longer one with at
    least ``subsumed_percent`` of its occurrences is left out. Order: score and a descending, then
    phrase. A null text has no words, a null language is ``no_lang``. Copies and repeated rows
    count each time. An empty table gives no rows. Other columns do not matter.
    """
    texts = _texts(docs, text_column, lang_column, no_lang)
    words = settle(count_words(texts).where((F.col("f") >= least) | F.col("word").isNull()), "collocation-words")
    known = words.where("word IS NOT NULL")
    entries, marks = {}, mark(hash_words(known), slots)
    for size in range(2, longest + 1):
        entries[size] = settle(hash_phrases(texts, size, marks, least, slots), f"collocation-hashes-{size}")
        if size < longest:
            marks = mark(entries[size], slots)
    stripes = settle(count_stripes(texts, entries, slots), "collocation-stripes")
    scored = _scored(stripes, known).join(_longer(stripes), ["lang", "phrase"], "left")
    scored = scored.where(F.coalesce(100 * F.col("longer") < subsumed_percent * F.col("a"), F.lit(True)))
    totals = words.where("word IS NULL").select("lang", F.col("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return first.join(hinted(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _scored(stripes: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (lang, phrase, a, l, r, score): the lowest-scoring cut of each candidate."""
    phrase = F.concat_ws(" ", "prefix", "next")
    counts = words.select("lang", F.col("word").alias("phrase"), "f").unionByName(stripes.select("lang", phrase.alias("phrase"), "f"))
    counts = hinted(settle(counts, "collocation-counts"))
    rows = stripes.select("lang", phrase.alias("phrase"), F.col("f").alias("a"), F.split(phrase, " ").alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    first = F.array_join(F.slice("w", F.lit(1), F.col("k")), " ")
    rest = F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ")
    rows = rows.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    rows = rows.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    rows = rows.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(CAST(2000000 AS DECIMAL(38, 0)) * a) DIV (l + r)").cast("long")
    best = rows.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _longer(stripes: DataFrame) -> DataFrame:
    """Rows (lang, phrase, longer): the most occurrences of a phrase with one word more at either end.

    A longer phrase that holds the candidate has no more occurrences than one of these.
    """
    tail = F.concat_ws(" ", F.expr("substring(prefix, instr(prefix, ' ') + 1)"), "next")
    held = stripes.where("size > 2").select("lang", F.explode(F.array("prefix", tail)).alias("phrase"), "f")
    return held.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
