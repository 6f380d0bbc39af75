"""Mixture-controlled packing of documents into training sequences by deficit round-robin.

Each source is a queue of tokens: its documents one after the other, each
ending in the end id. A round gives every queue credit for its share of a window
(``window`` tokens times the queue's part of all tokens); a queue is served whole runs of
``least_run`` tokens as its credit allows, and what is left stays as deficit for the next
round. So every round holds the sources in their target proportions and all queues run out together. The
rounds, one after the other, are the stream; each ``window`` tokens of it are a
sequence. The tokens after the last whole window go to sequences of falling powers
of two, which need no padding, so nothing is padded at all.

The credit that a queue has been given before round k is k times its quantum, so how much it
has been served, and with it the deficit that round k starts with, follows from
k alone. Tasks carry deficits on without waiting for each other: a task knows where
its documents start in their queues (from sums by task and source) and finds each
document's rounds, its places in them and its cuts by integer arithmetic.

Texts are tokenized once, into a written table; no token is ever shuffled.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityscan.llm.common import in_order, shared_table, text_bytes, with_ids

#: Fixed values of the query: tokens of a sequence, the id after each document.
WINDOW = 2048
END_ID = 1

#: Tokens that a queue is served at once, and the most queues: the sources with fewer tokens share the last one.
LEAST_RUN = 16
QUEUES = 256


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A run of these marks that ends a chunk is encoded apart if one of ``_BEFORE`` stands before it: the splitter parts them there always.
#: The letters are those that are one letter in small, too ("\u0130" is a letter and an accent then).
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017e\u03b1-\u03c9\u0430-\u045f"
_BEFORE = f"[0-9{_LETTERS}]$"
_WORD = re.compile(f"[{_LETTERS}]+")


class Vocabulary:
    """Texts to ids by way of their distinct chunks between ASCII white space, each encoded once while it is remembered.

    That holds for vocabularies whose normalizer and splitter lower the case and never join text across white space
    (tried out on a few words at the start; with others every text is encoded as a whole). The marks at a chunk's end are a piece
    apart. Unknown pieces are encoded many at once, which costs less than one by one; words of small letters alone skip the
    normalizer and the splitter, which leave them as they are, and where the vocabulary marks a word's last id, the ids alone tell
    the words apart. Two generations of pieces are kept, the younger one until it has over ``limit``: what it meets
    again stays. A text that might hold a special token, whose case matters, is encoded as it is.
    """

    limit = 1 << 18

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.young, self.old = {"": b""}, {}
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix, ids = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.last = np.zeros(max(ids.values(), default=0) + 1, bool)
        self.last[[i for t, i in ids.items() if suffix and t.endswith(suffix)]] = True
        tried = "Reading", "of", "a", "zqxjk", "d\u00e9", "12.", "it's", "a,"
        apart = [i for w in tried for i in self._ids(w.lower())]
        self.by_chunk = apart == self._ids(" \n".join(tried))
        self.by_chunk &= [i for w in tried[:5] for i in self._ids(w.lower())] == self.letters.encode(" ".join(tried[:5]).lower()).ids

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _known(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces, all of which are in the younger generation then."""
        if len(self.young) > self.limit:
            self.young, self.old = {"": b""}, self.young
        young, old, words, rest = self.young, self.old, [], []
        out = list(map(young.get, pieces))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            c = pieces[i]
            if c in old:
                young[c] = out[i] = old[c]
            elif c.isascii() and c.isalpha() or c.islower() and _WORD.fullmatch(c):
                words.append(i)
            else:
                rest.append(i)
        for numbers, encode in (words, self._of_words), (rest, self._of_any):
            for at in range(0, len(numbers), 4096):
                part = [pieces[i] for i in numbers[at:at + 4096]]
                ids, cuts = encode(part)
                body, cuts = np.array(ids, self.kind).tobytes(), (cuts * np.dtype(self.kind).itemsize).tolist()
                each = [body[i:j] for i, j in zip(cuts, cuts[1:])]
                young.update(zip(part, each))
                for i, x in zip(numbers[at:at + 4096], each):
                    out[i] = x
        return out

    def _of_words(self, words: list[str]) -> tuple[list[int], np.ndarray]:
        """The ids of words of small letters, one after the other, and where they begin and the last one ends."""
        text = " ".join(words)
        ids = self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            return ids, np.append(0, ends)
        found = self.letters.encode(text, add_special_tokens=False)
        return found.ids, np.searchsorted(found.word_ids, np.arange(len(words) + 1))

    def _of_any(self, pieces: list[str]) -> tuple[list[int], np.ndarray]:
        """The same of any pieces, told apart by the places of their ids in the text."""
        found = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        starts = np.cumsum([0, *[len(t) + 1 for t in pieces]])
        return found.ids, np.searchsorted(np.array([o[0] for o in found.offsets], np.int64), starts)

    def _ids_of(self, chunks: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of each distinct chunk, put together from those of what stands before its marks and of the marks."""
        cores = pc.ascii_rtrim(chunks, characters=_MARKS)
        ends = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset:][:len(chunks) + 1]
        apart = pc.match_substring_regex(cores, _BEFORE).to_numpy(zero_copy_only=False)
        cuts = np.empty(2 * len(chunks) + 1, np.int64)
        cuts[::2] = ends
        cuts[1::2] = np.where(apart, ends[:-1] + pc.binary_length(cores).to_numpy(), ends[1:])
        pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), chunks.buffers()[2]).dictionary_encode()
        known = self._known(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(known, pa.large_binary()).take(pieces.indices)
        bounds = np.frombuffer(ids.buffers()[1], np.int64)[:len(cuts)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(bounds[::2].copy()), ids.buffers()[2]])

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text as little-endian numbers of ``kind``."""
        special = {i: t for i, t in enumerate(texts) if t and (b"<|" in t or not self.by_chunk)}
        low = pa.array([t.lower() if t and i not in special else b"" for i, t in enumerate(texts)], pa.large_binary())
        split = pc.ascii_split_whitespace(low.cast(pa.large_string()))
        chunks = split.flatten().dictionary_encode()
        ids = self._ids_of(chunks.dictionary).take(chunks.indices)
        place = np.frombuffer(ids.buffers()[1], np.int64)[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        body = memoryview(ids.buffers()[2] or b"")
        out = [bytes(body[i:j]) for i, j in zip(place, place[1:])]
        for i, t in special.items():
            out[i] = np.array(self._ids(t.decode()), self.kind).tobytes()
        return out


@lru_cache(maxsize=1)
def _vocabulary(path: str, size: int, changed: int) -> Vocabulary:
    return Vocabulary(path)


def vocabulary_of(path: str) -> Vocabulary:
    """The vocabulary of a file; a Python worker keeps the last one, and what it learned, for its next tasks while the file stays as it is."""
    file = os.stat(path)
    return _vocabulary(path, file.st_size, file.st_mtime_ns)


def _slices(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, list[bytes | None]]]:
    """A text column in parts of bounded bytes: where each starts, and its texts."""
    start, part, n = 0, [], 0
    for i, t in enumerate(text_bytes(column)):
        part.append(t)
        n += len(t or b"")
        if n >= most:
            yield start, part
            start, part, n = i + 1, [], 0
    if part:
        yield start, part


def tokenize(docs: DataFrame, text: str, source: str, vocabulary: str, end_id: int) -> DataFrame:
    """``docs`` without the text, with __source, __tokens, __ids (little-endian, 16 bits each if all ids fit, else 32),
    and __task and __at: how many tokens of the source stand before the row in its task."""
    kept = [c for c in docs.columns if c != text]
    src = docs.select(*kept, F.col(source).cast("string").alias("__source"), F.col(text).cast("string").alias("__text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, served = vocabulary_of(vocabulary), TaskContext.get().partitionId(), {}
        end = np.array([end_id], known.kind).tobytes()
        for batch in batches:
            for start, texts in _slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(start, len(texts))
                ids, at, n = [], [], []
                texts = known.encode(texts)
                for name, t in zip(part.column(part.num_columns - 2).to_pylist(), texts):
                    ids.append(t + end)
                    n.append(len(ids[-1]) // len(end))
                    at.append(served.get(name, 0))
                    served[name] = at[-1] + n[-1]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array([task] * len(n), pa.int64()),
                     pa.array(at, pa.int64())], [*part.schema.names[:-1], "__tokens", "__ids", "__task", "__at"])

    schema = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in [*kept, "__source"])
    return src.mapInArrow(encode, f"{schema}, __tokens long, __ids binary, __task long, __at long")


class Rounds:
    """The rounds of queues with so many tokens: where each queue's tokens lie in the stream."""

    def __init__(self, tokens: list[int], window: int, least_run: int):
        self.tokens, self.window, self.run, self.total = tokens, window, least_run, sum(tokens)
        self.last = -(-self.total // window) - 1 if self.total else 0
        self.whole = self.total // window * window
        self.served = lru_cache(maxsize=8192)(self._served)
        self.starts = lru_cache(maxsize=8192)(self._starts)

    def _served(self, k: int) -> list[int]:
        """By queue, the tokens before round ``k``: whole runs of the credit of k rounds, all after the last."""
        if k > self.last:
            return self.tokens
        credit, least = self.window * k, self.total * self.run
        return [min(t, credit * t // least * self.run) for t in self.tokens]

    def _starts(self, k: int) -> list[int]:
        """By queue, the place in the stream where its run of round ``k`` starts."""
        served, after, out = self.served(k), self.served(k + 1), []
        at = sum(served)
        for a, b in zip(served, after):
            out.append(at)
            at += b - a
        return out

    def round_of(self, queue: int, token: int) -> int:
        """The round in which the queue's token of that number is served."""
        runs = token // self.run + 1
        return min(self.last, -(-runs * self.run * self.total // (self.window * self.tokens[queue])) - 1)

    def pieces(self, queue: int, first: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(token, length, sequence, offset) of each piece of a document whose ``n`` tokens start at ``first``."""
        at, stop, window = first, first + n, self.window
        k = self.round_of(queue, at)
        while at < stop:
            upto = self.served(k + 1)[queue]
            if upto <= at:
                k += 1
                continue
            place = self.starts(k)[queue] + at - self.served(k)[queue]
            upto = min(stop, upto)
            while at < upto:
                if place < self.whole:
                    sequence, offset = divmod(place, window)
                    length = min(window - offset, upto - at)
                else:
                    sequence, offset, room = self.sequence_of(place)
                    length = min(room, upto - at)
                yield at - first, length, sequence, offset
                at += length
                place += length
            k += 1

    def sequence_of(self, place: int) -> tuple[int, int, int]:
        """The sequence of a place after the last whole window, the offset there and the tokens up to its end."""
        rest, into, sequence = self.total - self.whole, place - self.whole, self.whole // self.window
        while True:
            size = 1 << (rest.bit_length() - 1)
            if into < size:
                return sequence, into, size - into
            rest, into, sequence = rest - size, into - size, sequence + 1


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str | None = None,
         window: int = WINDOW, end_id: int = END_ID, least_run: int = LEAST_RUN, queues: int = QUEUES) -> DataFrame:
    """One row a piece: ``doc_id``, source, start, length, ids (little-endian 32 bits), doc_tokens, sequence_id, offset.

    A null or empty text has the end id alone. A null source is a source of its own. Repeated
    ids are documents of their own. An empty table has no pieces. Of more than ``queues`` sources
    the smaller ones share a queue, source by source. Documents stand in their queue in the order of the
    table's files, so the same files give the same packing. Only the three named columns are read.
    """
    rows = docs.select(F.col(doc_id).alias("__doc"), F.col(source).cast("string").alias("__src"), F.col(text).alias("__whole"))
    encoded = shared_table(tokenize(rows, "__whole", "__src", vocabulary or default_vocabulary(), end_id).drop("__src"), "packing-ids")
    sums = shared_table(encoded.groupBy("__source", "__task").agg(F.sum("__tokens").alias("n")), "packing-sums")
    sizes = sums.groupBy("__source").agg(F.sum("n").alias("n"))
    # the sources with most tokens have queues of their own; the rest is one number here
    large = [(r[0], r[1]) for r in sizes.orderBy(F.desc("n"), F.col("__source").asc_nulls_first()).limit(queues - 1).collect()]
    total = sums.agg(F.sum("n")).first()[0] or 0
    tokens = [n for _, n in large]
    if total > sum(tokens):
        tokens.append(total - sum(tokens))
    queue = F.lit(len(large))
    for i, (name, _) in enumerate(large):
        queue = F.when(F.col("__source").eqNullSafe(F.lit(name)), i).otherwise(queue)
    starts = shared_table(_starts(sums.withColumn("__queue", queue.cast("int"))), "packing-starts")
    placed = with_ids(encoded.withColumn("__name", F.coalesce(F.concat(F.lit("="), "__source"), F.lit("-"))), starts, ["__task", "__name"], "inner")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(tokens, window, least_run)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                row, found, ids = [], [], []
                whole = list(text_bytes(part.column(3)))
                for i, (n, q, at) in enumerate(zip(*(part.column(c).to_pylist() for c in (2, 4, 5)))):
                    whole[i] = np.frombuffer(whole[i], f"<u{len(whole[i]) // n}").astype("<u4").tobytes()
                    for p in rounds.pieces(q, at, n):
                        row.append(i)
                        found.append(p)
                        ids.append(whole[i][4 * p[0]:4 * (p[0] + p[1])])
                take = pa.array(row, pa.int64())
                number = np.array(found, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(number[:, 0]), pa.array(number[:, 1]), pa.array(ids, pa.binary()),
                     part.column(2).take(take), pa.array(number[:, 2]), pa.array(number[:, 3])],
                    [doc_id, source, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = encoded.schema["__doc"].dataType.simpleString()
    src = placed.select("__doc", "__source", "__tokens", "__ids", "__queue", (F.col("__start") + F.col("__at")).alias("__first"))
    return src.mapInArrow(cut, f"`{doc_id}` {kind}, `{source}` string, start long, length long, ids binary, doc_tokens long, "
                               "sequence_id long, offset long")


def _starts(sums: DataFrame) -> DataFrame:
    """``(__task, __name, __queue, __start)``: how many tokens of its queue stand before a task's ones of a source.

    Ordered by queue, source and task.
    """
    placed = in_order(sums, [F.col("__source").asc_nulls_first(), F.col("__task")], "packing-order", ["__queue"], "__start", "n")
    return placed.select("__task", F.coalesce(F.concat(F.lit("="), "__source"), F.lit("-")).alias("__name"), "__queue", "__start")


def assemble(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, n_tokens, ids)``: the packed sequences, padded to ``window`` but for those of a power of two.

    A sequence gathers at most ``window`` pieces.
    """
    of = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    whole = F.array_join(F.transform("p", lambda p: F.hex(p["ids"])), "")
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    pad = F.when(power, F.lit("")).otherwise(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex().upper()), (F.lit(window) - F.col("n_tokens")).cast("int")))
    return of.select("sequence_id", "n_tokens", F.unhex(F.concat(whole, pad)).alias("ids"))
