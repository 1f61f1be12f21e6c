"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model has n-grams up to ``order`` with a Dirichlet prior: after the context h of k - 1
tokens with C(h) training occurrences, Pk(w | h) = (C(h, w) + MU * Pk-1(w | h')) / (C(h) + MU),
h' being h without its first token, and Pk = Pk-1 where h is new.  P1(w) = (c(w) + 1) /
(N + V + 1) leaves one share for all unknown words.  The trie stores the quantised smoothed
probability C(h, w) / (C(h) + MU) of each training n-gram; the share MU / (C(h) + MU) of the
lower order follows from C(h).  Words are lower-cased (A-Z); every text ends in an end token,
and starts after a start context.

The work is cut twice.  By documents: a chunk is a run of documents with about CHUNK tokens,
for which only its distinct words and distinct n-grams leave the task.  By n-grams: a shard of
a level sums the counts of all chunks for its n-grams, builds its trie and answers the chunks'
lookups; a frequent context is spread over shards by its words.  A level is asked after the
one before has answered: the answer names each n-gram's node (its shard and place there), and
nodes are the contexts of the next level, whose counts follow from the stored probability
(exactly below 2,000, within 0.03 % above).  Chunks and shards have a bounded size and grow in
number with the corpus; no task and not the driver holds the model.

Defined cases: a null, empty or blank text is the end token alone; whole texts are scored;
repeated rows teach and are scored each; without training documents P1 is 1 for every token
and all scores are 0; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellforge.llm.tables import ranked, stash, unstash
from cellforge.llm.trie import Trie, dequantise

MU = 100.0
CHUNK = 2_500_000  # tokens of a chunk, but for its last document
SHARD = 2_000_000  # training and lookup tokens per shard, on average
SPREAD = 8  # a context of over SHARD / SPREAD occurrences is spread over shards
END, START, UNKNOWN = 0, 1, -1  # ids; words have 2 and up
LOW = 0xFFFFFFFF  # an n-gram is its context's number << 32 | word; a node is shard << 32 | place

PACKED_ROWS = 500_000  # word rows packed at a time
CHUNK_ROWS = "chunk long, doc_ids array<long>, train binary, lengths binary, tokens binary, words array<binary>, counts array<int>"
RESOLVED_ROWS = "chunk long, doc_ids array<long>, train binary, lengths binary, tokens binary, ids binary, counts binary"
LEVEL = "array<struct<shard: int, codes: binary, places: binary>>"  # a level's answers to a chunk


def _pack(values: np.ndarray, level: int = 1) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), level)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype=kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=0))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, "<i8"))


def write_chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``doc_id, text, train`` -> rows of CHUNK_ROWS.  Token 0 is the end, n is words[n - 1];
    counts are those in the chunk's training documents."""
    part, number = TaskContext.get().partitionId(), 0

    def chunk() -> pd.DataFrame:
        tokens, trained = np.concatenate(lines), np.repeat(np.array(train), [len(x) for x in lines])
        counts = np.bincount(tokens[trained], minlength=len(seen) + 1)[1:]
        return pd.DataFrame(
            [((part << 32) + number, docs, np.array(train, dtype=np.uint8).tobytes(), _pack(np.array([len(x) for x in lines], dtype="<i4")),
              _pack(tokens, 4), list(seen), counts.astype(np.int32))],
            columns=["chunk", "doc_ids", "train", "lengths", "tokens", "words", "counts"],
        )

    seen = defaultdict(count(1).__next__)
    docs, train, lines, size = [], [], [], 0
    for frame in frames:
        for doc, text, is_train in zip(frame["doc_id"], frame["text"], frame["train"]):
            words = (text or "").encode("utf-8", "replace").lower().split()
            line = np.zeros(len(words) + 1, dtype="<i4")  # its last token is the end
            line[:-1] = np.fromiter(map(seen.__getitem__, words), dtype="<i4", count=len(words))
            docs.append(None if pd.isna(doc) else int(doc))
            train.append(bool(is_train))
            lines.append(line)
            size += len(line)
            if size >= CHUNK:
                yield chunk()
                number += 1
                seen = defaultdict(count(1).__next__)
                docs, train, lines, size = [], [], [], 0
    if docs:
        yield chunk()


def batched(body, rows: int):
    """``body`` on frames of about ``rows`` rows, put together from smaller ones."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def joined() -> Iterator[pd.DataFrame]:
            held, size = [], 0
            for frame in frames:
                held.append(frame)
                size += len(frame)
                if size >= rows:
                    yield pd.concat(held, ignore_index=True)
                    held, size = [], 0
            if size:
                yield pd.concat(held, ignore_index=True)

        return body(joined())

    return run


class Grams:
    """A chunk's tokens, their probabilities by the levels answered so far, and the chunk's
    distinct known n-grams of the next level, in order."""

    def __init__(self, row, levels: list, starts: int, mu: float, total: int, kinds: int, shards: int) -> None:
        self.tokens, self.lengths = _unpack(row.tokens, "<i4"), _unpack(row.lengths, "<i4").astype(np.int64)
        self.train = np.frombuffer(row.train, dtype=np.uint8).astype(bool)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.mu, self.shards = mu, shards
        ids, self.kind_counts = _unpack(row.ids, "<i4"), _unpack(row.counts, "<i8")
        self.ids, self.kind_base = ids[self.tokens], (self.kind_counts + 1.0) / (total + kinds + 1.0)
        self.p = self.kind_base[self.tokens]
        contexts, held = np.append(ids, START).astype(np.int64), np.append(self.kind_counts, starts)
        number = self._contexts(np.where(held > 0, contexts, UNKNOWN), held)
        self._open(number[self.tokens], number[-1])
        for level in levels:
            self._read(level)

    def _contexts(self, nodes: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Sets the next level's contexts, in order, with their occurrences; the number of
        each of ``nodes`` among them (UNKNOWN has none)."""
        there = np.flatnonzero(nodes >= 0)
        there = there[np.argsort(nodes[there], kind="stable")]
        self.contexts, self.held = nodes[there], held[there]
        number = np.full(len(nodes), UNKNOWN, dtype=np.int32)
        number[there] = np.arange(len(there))
        return number

    def _open(self, ends: np.ndarray, start: int) -> None:
        """The next level: a token's context is what ends at the token before."""
        context = np.empty_like(ends)
        context[1:] = ends[:-1]
        context[self.first] = start
        self.p *= np.append(self.mu / (self.held + self.mu), 1.0)[context]  # the last one where there is no context
        self.known = (self.ids >= 0) & (context >= 0)
        keys = (context[self.known].astype(np.int64) << 32) | self.ids[self.known]
        del context
        self.grams, where = np.unique(keys, return_inverse=True)
        del keys
        self.where = where.astype(np.int32)
        trained = np.repeat(self.train, self.lengths)[self.known]
        self.trained = np.bincount(self.where[trained], minlength=len(self.grams)).astype("<i4")

    def _read(self, answers: list) -> None:
        """Adds the level's probabilities; opens the next one where the answers have places."""
        told = {x["shard"]: x for x in answers}
        stored, node = np.zeros(len(self.grams)), np.full(len(self.grams), UNKNOWN, dtype=np.int64)
        for shard, mine in self.by_shard():
            codes = _unpack(told[shard]["codes"], "<u2")
            stored[mine] = np.where(codes > 0, 10.0 ** dequantise(codes), 0.0)
            if told[shard]["places"] is not None:
                node[mine[codes > 0]] = (shard << 32) | _unpack_sorted(told[shard]["places"])
        self.p[self.known] += stored[self.where]
        if any(x["places"] is not None for x in answers):
            times = np.rint(stored * (self.held[self.grams >> 32] + self.mu)).astype(np.int64)
            del stored, self.grams, self.trained
            ends = np.full(len(self.ids), UNKNOWN, dtype=np.int32)
            ends[self.known] = self._contexts(node, times)[self.where]
            del node, times, self.where
            self._open(ends, UNKNOWN)

    def _shard(self, contexts: np.ndarray, part) -> np.ndarray:
        mixed = (contexts * 1_000_003 + part).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(33)) % np.uint64(self.shards)).astype(np.int32)

    def by_shard(self) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, places of its n-grams in order); an n-gram's shard depends on the n-gram
        and its context's count alone."""
        spread = -(-self.held * SPREAD // SHARD)
        shard = self._shard(self.contexts, 0)[self.grams >> 32]
        if (spread > 1).any():
            hot = np.flatnonzero((spread > 1)[self.grams >> 32])
            number = self.grams[hot] >> 32
            shard[hot] = self._shard(self.contexts[number], (self.grams[hot] & LOW) % spread[number])
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for start, stop in zip(cuts, np.append(cuts[1:], len(order))):
            yield int(shard[order[start]]), order[start:stop]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of token values by document."""
        return np.add.reduceat(values, self.first) if len(self.first) else np.empty(0)


def score_documents(docs: DataFrame, train: str, key: str = "doc_id", text: str = "text", mu: float = MU, order: int = 2) -> DataFrame:
    """``key, train, n_tokens, n_known, train_tokens, base_score, score``: a row for each row
    of ``docs``, scores as log10; learns n-grams up to ``order`` (2 or more) where the boolean
    column ``train`` holds."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{train}`"), F.lit(False)).alias("train")
    )
    chunks = stash(rows.mapInPandas(write_chunks, CHUNK_ROWS), "lm-chunks")

    # Words: counts over all chunks, ids by frequency for those that training has seen.
    spelled = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "chunk", "pos", F.col("col.words").alias("word"), F.col("col.counts").alias("n")
    )
    counted = stash(spelled.groupBy("word").agg(F.sum("n").alias("c")).where(F.col("c") > 0), "lm-counts")
    vocabulary, kinds = ranked(counted, [F.desc("c"), "word"], "lm-words")
    words = counted.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    taught = F.length(F.translate(F.hex("train"), "0", ""))  # a byte 01 for each training document
    starts = int(chunks.agg(F.coalesce(F.sum(taught), F.lit(0))).first()[0])  # start contexts, and end tokens
    total, kinds = int(words) + starts, kinds + (1 if starts else 0)
    shards = max(1, -(-total // SHARD))

    def resolve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """A chunk with the ids and counts of its words instead of the words."""
        row = left.iloc[0]
        ids, counts = np.full(row["kinds"] + 1, UNKNOWN, dtype="<i4"), np.zeros(row["kinds"] + 1, dtype="<i8")
        ids[0], counts[0] = END if starts else UNKNOWN, starts
        for at, of, c in zip(right["pos"], right["id"], right["c"]):
            at = _unpack(at, "<i4") + 1
            ids[at], counts[at] = _unpack(of, "<i4"), _unpack(c, "<i8")
        return left.drop(columns="kinds").assign(ids=[_pack(ids)], counts=[_pack(counts)])

    def pack_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """``of, pos, id, c`` rows as one row of arrays for each chunk and batch."""
        for frame in frames:
            frame = frame.sort_values(["of", "id"])
            first = np.flatnonzero(np.diff(frame["of"].to_numpy(), prepend=-1))
            cut = [np.split(frame[k].to_numpy().astype(t), first[1:]) for k, t in (("pos", "<i4"), ("id", "<i4"), ("c", "<i8"))]
            packed = [[_pack(x) for x in parts] for parts in cut]
            yield pd.DataFrame({"of": frame["of"].to_numpy()[first], "pos": packed[0], "id": packed[1], "c": packed[2]})

    told = spelled.join(vocabulary, "word").select(
        F.col("chunk").alias("of"), "pos", (F.col("_rank") + 2).alias("id"), "c"
    )
    told = told.mapInPandas(batched(pack_words, PACKED_ROWS), "of long, pos binary, id binary, c binary")
    bare = chunks.select("chunk", "doc_ids", "train", "lengths", "tokens", F.size("words").alias("kinds"))
    resolved = bare.groupBy("chunk").cogroup(told.groupBy("of")).applyInPandas(resolve, RESOLVED_ROWS)
    resolved = stash(resolved, "lm-resolved")
    for done in (chunks, counted, vocabulary):
        unstash(done)

    def grams(row, levels: list) -> Grams:
        return Grams(row, levels, starts, mu, total, kinds, shards)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The distinct n-grams of each chunk, by shard, as contexts and their words."""
        for frame in frames:
            for row in frame.itertuples():
                own, out = grams(row, [getattr(row, name) for name in names(frame.columns)]), []
                del own.tokens, own.ids, own.p, own.known, own.where  # what only scores need
                for shard, mine in own.by_shard():
                    keys = own.grams[mine]
                    first = np.flatnonzero(np.diff(keys >> 32, prepend=-1))
                    packed = (
                        _pack_sorted(own.contexts[keys[first] >> 32]), _pack(np.diff(first, append=len(keys)).astype("<i4")),
                        _pack((keys & LOW).astype("<i4")), _pack(own.trained[mine]), _pack(own.held[keys[first] >> 32]),
                    )
                    out.append((shard, row.chunk, *packed))
                if out:
                    yield pd.DataFrame(out, columns=["shard", "chunk", "contexts", "sizes", "words", "trained", "held"])

    def names(columns) -> list[str]:
        return sorted(c for c in columns if c.startswith("level"))

    def answer(last: bool):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            """A shard's trie from all chunks' counts; the codes (and, but for the last level,
            the places) of each chunk's n-grams."""

            nodes = [_unpack_sorted(x) for x in frame["contexts"]]
            contexts, index, number = np.unique(np.concatenate(nodes), return_index=True, return_inverse=True)
            held = np.concatenate([_unpack(x, "<i8") for x in frame["held"]])[index]
            cuts = np.cumsum([len(x) for x in nodes])[:-1]
            del nodes, index

            def keys_of(row, number: np.ndarray) -> np.ndarray:
                return (np.repeat(number, _unpack(row.sizes, "<i4")) << 32) | _unpack(row.words, "<i4")

            keys, times = [], []
            for row, numbers in zip(frame.itertuples(), np.split(number, cuts)):
                trained = _unpack(row.trained, "<i4")
                keys.append(keys_of(row, numbers)[trained > 0])
                times.append(trained[trained > 0])
            keys, where = np.unique(np.concatenate(keys), return_inverse=True)
            times = np.bincount(where, weights=np.concatenate(times), minlength=len(keys))
            log10 = np.log10(np.maximum(times, 1) / (held[keys >> 32] + mu))
            del where, times, held
            trie = Trie.mapped(Trie.encode(contexts[keys >> 32], keys & LOW, log10))
            del keys, log10
            codes, places = [], []
            for row, numbers in zip(frame.itertuples(), np.split(number, cuts)):
                asked = keys_of(row, numbers)
                found, at = trie.locate(contexts[asked >> 32], asked & LOW)
                codes.append(_pack(found))
                places.append(None if last else _pack_sorted(at[found > 0]))
            return pd.DataFrame({"chunk": frame["chunk"], "shard": frame["shard"], "codes": codes, "places": places})

        return run

    def records(answers: pd.DataFrame) -> list:
        return answers[["shard", "codes", "places"]].to_dict("records")

    def attach(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """A chunk with a level's answers."""
        return left.assign(**{f"level{len(names(left.columns)) + 2}": [records(right)]})

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = next(left.itertuples())
        own = grams(row, [*[getattr(row, name) for name in names(left.columns)], records(right)])
        return pd.DataFrame({
            "doc_id": pd.array(row.doc_ids, dtype="Int64"), "train": own.train, "n_tokens": own.lengths,
            "n_known": own.sums((own.kind_counts > 0).astype(np.int64)[own.tokens]),
            "base_score": own.sums(np.log10(own.kind_base)[own.tokens]), "score": own.sums(np.log10(np.minimum(own.p, 1.0))),
        })

    state, rows_of = resolved, RESOLVED_ROWS
    for level in range(2, order + 1):
        asks = state.mapInPandas(ask, "shard int, chunk long, contexts binary, sizes binary, words binary, trained binary, held binary")
        answers = asks.groupBy("shard").applyInPandas(answer(level == order), "chunk long, shard int, codes binary, places binary")
        met = state.groupBy("chunk").cogroup(answers.groupBy("chunk"))
        if level < order:
            rows_of = f"{rows_of}, level{level} {LEVEL}"
            before, state = state, stash(met.applyInPandas(attach, rows_of), f"lm-level{level}")
            unstash(before)
    done = met.applyInPandas(score, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return done.select(
        F.col("doc_id").alias(key), "train", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
