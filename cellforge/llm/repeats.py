"""Repeated passages across documents, from common-prefix intervals of suffix arrays.

A byte is removed if a string of ``least`` bytes around it also starts earlier: in a document
that comes before, or earlier in the same one.  Documents are ordered by key; strings are
bytes of the whole UTF-8 texts, never cross documents, and are judged on the input.

One suffix array of all texts would hold every suffix; here suffixes are dealt to buckets so
that those that share ``least`` bytes meet:

1. Every string of ``least`` bytes has an anchor: of the short strings in it, the one of the
   least hash.  A run of strings with one anchor is a segment of the text, and equal strings
   have equal anchors at equal places.  Each task sends a segment once, by the hashes of anchor
   and segment; a further copy in the task is known to come later.
2. Segments meet by anchor.  All but the first of equal segments are repeats as a whole.  Only
   where an anchor has different segments are their bytes fetched, the first copy of each.
3. The bytes of an anchor's segments make a bucket.  Its suffix array with common prefixes
   is scanned with a stack (``intervals``); the intervals of ``least`` bytes or more that
   differ in the byte before are the maximal repeats, each with all its occurrences.
4. An anchor with more than HOT different segments is cut further: every string of ``least``
   bytes there is a bucket of its own, whose only interval is that string.

Defined cases: a null text is empty; a text under ``least`` bytes loses nothing; rows of one
key and one text are one document and share its result; rows of one key with different texts
are documents in the order of their hashes; a null key comes first; no other column is
read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellforge.llm.intervals import NONE, maximal_intervals, sorted_suffixes
from cellforge.llm.tables import ranked, stash, unstash

LEAST = 100
HOT = 1024  # different segments of one bucket
PIECE = 1 << 20  # string starts scanned at once
ROWS = 1 << 20  # anchors that a task combines at once
BATCH = 4096  # segments that a task sorts at once
ODD = 0x9E3779B97F4A7C15
BYTES = np.random.default_rng(2024).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
POSITION = np.uint64(0xFFFFFF)

ANCHOR = "key long, seg long, d long, tie long, p int, o int, len int"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Hasher:
    """Hashes of substrings, from running sums of letter values times powers (mod 2**64)."""

    def __init__(self, size: int):
        self.power = np.cumprod(np.full(size + 1, ODD, dtype=np.uint64))
        self.inverse = np.cumprod(np.full(size + 1, pow(ODD, -1, 2**64), dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTES[data] * self.power[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((sums[stop] - sums[start]) * self.inverse[start])


def anchor_bytes(least: int) -> int:
    return max(1, 2 * least // 5)


def segments(data: np.ndarray, ends: np.ndarray, least: int, piece: int = PIECE, hasher: Hasher | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor's hash, segment's hash, start, start of the anchor, stop) of every segment of
    the texts that lie in ``data`` one after the other and stop at ``ends``."""
    k = anchor_bytes(least)
    window = least - k + 1
    hasher = hasher or Hasher(piece + 2 * window + least)
    for c in range(0, len(data), piece):
        lo, hi = max(0, c - window), min(len(data), c + piece + window + least)
        x, n = data[lo:hi], hi - lo
        if n < least:
            continue
        sums = hasher.sums(x)
        grams = _mix((sums[k:] - sums[:-k]) * hasher.inverse[: n - k + 1])
        low, have = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64), 1
        while have < window:
            step = min(have, window - have)
            low, have = np.minimum(low[:-step], low[step:]), have + step
        # A string may start where its text has ``least`` bytes left.
        first, last = np.searchsorted(ends, [lo, hi], side="right")
        stops = np.minimum(ends[first : last + 1], hi) - lo
        starts = np.append(0, stops[:-1])
        change = np.zeros(n + 1, dtype=np.int64)
        room = stops - starts >= least
        np.add.at(change, starts[room], 1)
        np.add.at(change, stops[room] - least + 1, -1)
        s = np.flatnonzero(np.cumsum(change)[: len(low)])
        if not len(s):
            continue
        a = (low[s] & POSITION).astype(np.int64)
        head = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)))
        p, stop = s[head], s[np.append(head[1:] - 1, len(s) - 1)] + least
        whole = (p + lo >= c) & (p + lo < c + piece)
        p, a, stop = p[whole], a[head][whole], stop[whole]
        yield grams[a], hasher.of(sums, p, stop), p + lo, a + lo, stop + lo


def _new(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _merged(d: np.ndarray, tie: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans with those that touch made one."""
    order = np.lexsort((start, tie, d))
    d, tie, start, stop = d[order], tie[order], start[order], stop[order]
    doc = np.cumsum(_new(d, tie)) if len(d) else np.empty(0, dtype=np.int64)
    reach = np.maximum.accumulate(stop + (doc << 32)) - (doc << 32) if len(d) else stop
    head = np.flatnonzero(_new(doc) | np.append(True, start[1:] > reach[:-1])) if len(d) else doc
    return d[head], tie[head], start[head], reach[np.append(head[1:], len(d)) - 1] if len(d) else reach


def _first_of_each(key, seg, d, tie, p, o, length) -> list[np.ndarray]:
    """Each (key, seg) once, at its first place, and spans of its other places as rows with
    o = -1, dealt by a hash of their place."""
    order = np.lexsort((p, tie, d, seg, key))
    key, seg, d, tie, p, o, length = (c[order] for c in (key, seg, d, tie, p, o, length))
    first = _new(key, seg)
    later = ~first & _new(key, seg, d, tie, p)  # a repeated row is no later place
    cd, ct, start, stop = _merged(d[later], tie[later], p[later].astype(np.int64), p[later].astype(np.int64) + length[later])
    at = _mix((cd * 31 + ct).astype(np.uint64) + start.astype(np.uint64)).view(np.int64)
    rows = [c[first] for c in (key, seg, d, tie, p, o, length)]
    more = [at, np.zeros_like(at), cd, ct, start, np.full(len(at), -1), stop - start]
    return [np.concatenate(pair) for pair in zip(rows, more)]


def _anchor_batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = [np.int64] * 4 + [np.int32] * 3
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, kinds)], names=["key", "seg", "d", "tie", "p", "o", "len"])


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each ends); a null one has none."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.empty(0, dtype=np.uint8)
    return data, offsets[1:] - offsets[0]


def keyed_texts(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """``id, d, tie, text`` of each row, its document by (d, tie) in their order; whether
    some rows are of one document."""
    name = F.col(f"`{key}`").cast("long")
    base = docs.select(name.alias("id"), F.coalesce(name, F.lit(-(2**63))).alias("d"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    hashed = base.select(F.col("id").isNotNull().alias("known"), F.xxhash64("text").alias("h"), "*")
    place = F.struct("known", "h")
    ids = hashed.groupBy("d").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.count(F.lit(1)).alias("n"))
    again = stash(ids.where("n > 1").select("d", (F.col("least") != F.col("most")).alias("several")), "repeat-ids")
    several = again.agg(F.max("several")).first()[0]  # null: no key twice
    if not several:
        return base.select("id", "d", F.lit(0).cast("long").alias("tie"), "text"), several is not None
    names = hashed.select("d", "known", "h").join(again.where("several").select("d"), "d", "left_semi").distinct()
    ties, _ = ranked(names, ["d", "known", "h"], "repeat-ties")
    ties = stash(ties.withColumnRenamed("_rank", "tie"), "repeat-ties")
    tied = hashed.join(ties, ["d", "known", "h"], "left")
    return tied.select("id", "d", F.coalesce("tie", F.lit(0).cast("long")).alias("tie"), "text"), True


def anchor_rows(texts: DataFrame, least: int) -> DataFrame:
    """Each task's segments once each, and the spans that it knows to be later copies."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(PIECE + 2 * least + least)
        held: list[list[np.ndarray]] = []
        n = 0
        for batch in batches:
            data, ends = _text_bytes(batch.column("text"))
            d, tie = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "tie"))
            for key, seg, p, a, stop in segments(data, ends, least, hasher=hasher):
                doc = np.searchsorted(ends, p, side="right")
                begins = np.append(0, ends[:-1])[doc]
                held.append([key.view(np.int64), seg.view(np.int64), d[doc], tie[doc], p - begins, a - p, stop - p])
                n += len(p)
                if n >= ROWS:
                    yield _anchor_batch(_first_of_each(*[np.concatenate(c) for c in zip(*held)]))
                    held, n = [], 0
        if n:
            yield _anchor_batch(_first_of_each(*[np.concatenate(c) for c in zip(*held)]))

    return texts.mapInArrow(scan, ANCHOR)


def settle(rows: DataFrame) -> DataFrame:
    """Rows of ANCHOR -> ``kind``: "later" (a span that repeats an earlier one as a whole),
    "ask" (the first of an anchor's different segments), "hot" (as ask, of too many)."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, seg, d, tie, p of the row before
        rest: list[np.ndarray] | None = None  # firsts of the last key so far
        spilled = False  # the last key is hot, and its firsts so far are out
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "seg", "d", "tie", "p", "o", "len")]
            if not len(cols[0]):
                continue
            key, seg, d, tie, p, o, length = cols
            new_seg, new_row = _new(key, seg), _new(key, seg, d, tie, p)
            if last is not None:
                new_seg[0] = (key[0], seg[0]) != last[:2]
                new_row[0] = (key[0], seg[0], d[0], tie[0], p[0]) != last
            span = o < 0
            later = span | (~new_seg & new_row)
            first = new_seg & ~span
            yield _settled([c[later] for c in cols], "later")
            goes_on = last is not None and key[0] == last[0]
            if not goes_on:
                if rest is not None:
                    yield from flush(rest, spilled)
                rest, spilled = None, False
            firsts = [c[first] for c in cols]
            if rest is not None:
                firsts = [np.concatenate(pair) for pair in zip(rest, firsts)]
            mine = firsts[0] == key[-1]
            done = [c[~mine] for c in firsts]
            if len(done[0]):
                if goes_on and spilled:  # the hot key ended in this batch
                    hot = done[0] == key[0]
                    yield _settled([c[hot] for c in done], "hot")
                    done = [c[~hot] for c in done]
                yield from flush(done, False)
            if key[-1] != key[0] or not goes_on:
                spilled = False
            rest = [c[mine] for c in firsts]
            if spilled or len(rest[0]) > HOT:
                yield _settled(rest, "hot")
                rest, spilled = [c[:0] for c in rest], True
            last = (key[-1], seg[-1], d[-1], tie[-1], p[-1])
        if rest is not None:
            yield from flush(rest, spilled)

    def flush(firsts: list[np.ndarray], spilled: bool) -> Iterator[pa.RecordBatch]:
        """Whole keys: those of one segment are done."""
        if spilled:
            yield _settled(firsts, "hot")
            return
        _, which, count = np.unique(firsts[0], return_inverse=True, return_counts=True)
        size = count[which] if len(which) else which
        yield _settled([c[(size > 1) & (size <= HOT)] for c in firsts], "ask")
        yield _settled([c[size > HOT] for c in firsts], "hot")

    def _settled(cols: list[np.ndarray], kind: str) -> pa.RecordBatch:
        key, _, d, tie, p, o, length = cols
        arrays = [pa.array([kind] * len(key), pa.string()), pa.array(key), pa.array(d), pa.array(tie), pa.array(p), pa.array(o), pa.array(length)]
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "key", "d", "tie", "p", "o", "len"])

    dealt = rows.repartition("key").sortWithinPartitions("key", "seg", "d", "tie", "p")
    return dealt.mapInArrow(groups, "kind string, key long, d long, tie long, p int, o int, len int")


def cut(texts: DataFrame, asked: DataFrame, least: int) -> DataFrame:
    """The ``bytes`` of asked segments, and every string of hot ones (``seg`` and no bytes;
    o = -1: spans of later copies).  ``texts`` has a document once."""
    wanted = asked.groupBy("d", "tie").agg(F.collect_list(F.struct("kind", "key", "p", "len")).alias("asked"))  # bounded by the text
    joined = texts.join(wanted, ["d", "tie"])

    def cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(2 * least)
        strings: list[list[np.ndarray]] = []
        n = 0
        for batch in batches:
            rows: list[tuple] = []
            for d, tie, text, wanted in zip(*[batch.column(c) for c in ("d", "tie", "text", "asked")]):
                d, tie, whole = d.as_py(), tie.as_py(), text.as_buffer().to_pybytes()
                for one in wanted.as_py():
                    p, stop = one["p"], one["p"] + one["len"]
                    if one["kind"] == "ask":
                        rows.append((one["key"], d, tie, p, whole[p:stop]))
                        continue
                    x = np.frombuffer(whole, dtype=np.uint8, count=stop - p, offset=p)
                    starts = np.arange(stop - p - least + 1)
                    seg = hasher.of(hasher.sums(x), starts, starts + least).view(np.int64)
                    full = np.full(len(starts), 1)
                    strings.append([seg ^ np.int64(one["key"]), seg, full * d, full * tie, starts + p, full * 0, full * least])
                    n += len(starts)
            if rows:
                key, d, tie, p, data = zip(*rows)
                yield _cut(key, [None] * len(rows), d, tie, p, [0] * len(rows), [len(x) for x in data], data)
            if n >= ROWS:
                yield from _strings(strings)
                strings, n = [], 0
        if n:
            yield from _strings(strings)

    def _strings(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        cols = _first_of_each(*[np.concatenate(c) for c in zip(*held)])
        yield _cut(*cols, [None] * len(cols[0]))

    def _cut(*columns) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.binary()]
        names = ["key", "seg", "d", "tie", "p", "o", "len", "bytes"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return joined.mapInArrow(cutting, f"{ANCHOR}, bytes binary")


def _groups_of(rows: list[tuple], least: int) -> tuple[np.ndarray, ...]:
    """Maximal repeats of whole buckets: rows (key, d, tie, p, bytes) in the order of
    key, d, tie and p -> (key, number of the repeat, d, tie, start, length, earlier)."""
    data = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint8)
    stop = np.cumsum([len(r[4]) for r in rows])
    start = np.append(0, stop[:-1])
    key, d, tie, p = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))
    bucket = np.cumsum(_new(key))
    at, seg, lcp = sorted_suffixes(data, start, stop, bucket, least)
    before = np.where(at > start[seg], data[at - 1].astype(np.int64), NONE) if len(at) else at
    found = maximal_intervals(lcp, before, least)
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(6)) + (np.empty(0, dtype=bool),)
    length, lo, hi = (np.array(c) for c in zip(*found))
    size = hi - lo + 1
    group = np.repeat(np.arange(len(found)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[group]
    s, where = seg[place], at[place] - start[seg[place]] + p[seg[place]]
    order = np.lexsort((where, tie[s], d[s], group))
    group, s, where = group[order], s[order], where[order]
    return key[s], group, d[s], tie[s], where, length[group], ~_new(group)


def repeat_groups(texts: DataFrame, asked: DataFrame, least: int) -> DataFrame:
    """``key, number, d, tie, start, len, earlier``: the maximal repeats of every bucket with
    all occurrences among its different segments (a repeat's name is key and number);
    earlier: the repeat also starts earlier.  Rows without a number are later copies."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last = None  # the string before
        for batch in batches:
            table = batch.to_pydict()
            later: list[tuple] = []
            for key, seg, d, tie, p, o, length, data in zip(*[table[c] for c in ("key", "seg", "d", "tie", "p", "o", "len", "bytes")]):
                if data is not None:
                    if rows and key != rows[-1][0] and len(rows) >= BATCH:
                        yield _groups(*_groups_of(rows, least))
                        rows = []
                    rows.append((key, d, tie, p, data))
                elif o < 0 or (last is not None and last[:2] == (key, seg) and last != (key, seg, d, tie, p)):
                    later.append((d, tie, p, length))
                if data is None and o >= 0 and (last is None or last[:2] != (key, seg)):
                    last = (key, seg, d, tie, p)
            if later:
                cols = [np.array(c, dtype=np.int64) for c in zip(*later)]
                d, tie, start, stop = _merged(cols[0], cols[1], cols[2], cols[2] + cols[3])
                yield _groups(np.zeros_like(d), None, d, tie, start, stop - start, np.ones(len(d), dtype=bool))
        if rows:
            yield _groups(*_groups_of(rows, least))

    def _groups(key, number, d, tie, start, length, earlier) -> pa.RecordBatch:
        number = pa.nulls(len(key), pa.int64()) if number is None else pa.array(number, pa.int64())
        arrays = [pa.array(key, pa.int64()), number, pa.array(d), pa.array(tie), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(earlier)]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "number", "d", "tie", "start", "len", "earlier"])

    order = ["key", "seg", "d", "tie", "p"]
    dealt = cut(texts, asked, least).repartition("key").sortWithinPartitions(*order)
    return dealt.mapInArrow(buckets, "key long, number long, d long, tie long, start long, len long, earlier boolean")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``key, n_bytes, removed, kept`` of each row: the removed runs of bytes (array of
    start and stop, none touches the next) and the remaining bytes."""
    texts, repeated = keyed_texts(docs, key, text)
    once = texts.dropDuplicates(["d", "tie"]) if repeated else texts
    settled = stash(settle(anchor_rows(texts, least)), "repeat-anchors")
    groups = repeat_groups(once, settled.where("kind != 'later'"), least).where("earlier")
    groups = stash(groups.select("d", "tie", "start", "len"), "repeat-groups")
    later = settled.where("kind = 'later'").select("d", "tie", F.col("p").cast("long").alias("start"), F.col("len").cast("long").alias("len"))
    spans = later.unionByName(groups).groupBy("d", "tie").agg(F.collect_list(F.struct("start", "len")).alias("spans"))  # bounded by the text
    run = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def removing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept, sizes = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                whole, mine = text.as_buffer().to_pybytes(), []
                for one in sorted((x["start"], x["start"] + x["len"]) for x in spans.as_py() or ()):
                    if mine and one[0] <= mine[-1][1]:
                        mine[-1] = (mine[-1][0], max(mine[-1][1], one[1]))
                    else:
                        mine.append(one)
                ends = [0, *[stop for _, stop in mine]]
                kept.append(b"".join(whole[a:b] for a, b in zip(ends, [*[start for start, _ in mine], len(whole)])))
                runs.append([{"start": a, "stop": b} for a, b in mine])
                sizes.append(len(whole))
            arrays = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(runs, run), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_bytes", "removed", "kept"])

    found = texts.join(spans, ["d", "tie"], "left").select("id", "text", "spans")
    out = found.mapInArrow(removing, "id long, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary")
    return out.withColumnRenamed("id", key)
