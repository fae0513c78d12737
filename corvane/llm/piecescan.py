"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

The model's segmentation is a byte-pair merge. A sequence of pieces is the
model's segmentation of a text exactly if each piece alone and each pair of neighbours are segmented as
they stand. So segmentation is a path problem: a state at a position is the
piece that covers the character before it, a step to the next piece weighs 0 if
the two may stand side by side and -inf if not, and the one path above -inf is the result.

A document longer than a limit is cut into chunks at fixed positions. Each
chunk gives the max-plus matrix from the states at its begin to those at its
end. The products of a document's matrices, which are associative, give the
state at each cut; each chunk is then traced on its own between its two states.

No piece has a word mark after another character, so a path always passes
between words: within a chunk only the words that a cut divides need states, and
whole words in between are segmented once and remembered (a bounded memory).
A word that no cut divides is segmented by the library.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import as_batch, by_arrow, partitions, text_slices, written

MARK = "▁"
#: Characters of a chunk, and of the longest document that is encoded in one go.
CHUNK = 16_384
#: Chunks whose matrices one task multiplies.
BLOCK = 64
HELD, LONGEST = 300_000, 48
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NONE = -np.inf


class Pieces:
    """A sentencepiece model: words to ids, whether pieces may be neighbours, and ids to text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.text = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [bytes([int(t[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) else t.replace(MARK, " ").encode() for i, t in enumerate(self.text)]
        plain = [i for i in range(n) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i))]
        self.ids = {self.text[i]: i for i in plain}
        self.longest = max(len(self.text[i]) for i in plain)
        self.byte_ids = {bytes([int(self.text[i][3:5], 16)]): i for i in range(n) if self.model.is_byte(i)}
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        first = self.model.encode("\n")  # what the model puts before a text, to strip it from words without a mark
        self.lead = first[: next(i for i, x in enumerate(first) if self.model.is_byte(x))]

    def marked(self, text: str) -> str:
        """The text as the model sees it."""
        return (MARK + text.replace(" ", MARK)) if text else ""

    def _word(self, word: str) -> bytes:
        if word.startswith(MARK):
            ids = self.model.encode(word[1:].replace(MARK, " ")) if len(word) > 1 else [self.ids[MARK]]
        else:  # a line end, which stands alone as a byte, keeps the model's own mark apart from the word
            ids = self.model.encode("\n" + word)[len(self.lead) + 1 :]
        return array("I", ids).tobytes()

    def encode_words(self, words: list[str]) -> bytes:
        """The ids of whole words, little-endian unsigned 32-bit."""
        got = list(map(self.words.get, words))
        if None in got:
            for i, (w, x) in enumerate(zip(words, got)):
                if x is None:
                    x = self.words.get(w)
                    if x is None:
                        x = self._word(w)
                        if len(w) <= LONGEST:
                            if len(self.words) >= HELD:
                                self.words.clear()
                            self.words[w] = x
                    got[i] = x
        return b"".join(got)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text in one go."""
        return self.encode_words(_WORDS.findall(self.marked(text)))

    def decode(self, ids: np.ndarray, first: bool = True) -> bytes:
        """The UTF-8 text of ids; `first`: of a document's begin, without the mark that the model put there."""
        out = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return out[1:] if first and out[:1] == b" " else out

    def may_follow(self, a: str, b: str) -> bool:
        """Whether two pieces are segmented as they stand side by side."""
        key = (a, b)
        if (known := self.pairs.get(key)) is None:
            whole = a + b
            known = self._texts(self._word(whole)) == [a, b] if len(_WORDS.findall(whole)) == 1 else True
            if len(self.pairs) >= HELD:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _texts(self, ids: bytes) -> list[str]:
        """Pieces' texts; bytes that spell a character make one."""
        out, held = [], b""
        for i in np.frombuffer(ids, "<u4").tolist():
            if self.model.is_byte(i):
                held += self.bytes[i]
                try:
                    out.append(held.decode())
                    held = b""
                except UnicodeDecodeError:
                    pass
            else:
                out.append(self.text[i])
        return out

    def alone(self, piece: str) -> bool:
        """Whether a piece is segmented as itself; a character without a piece stands alone as its bytes."""
        return (piece in self.ids or len(piece) == 1) and self._texts(self.encode_words([piece])) == [piece]

    def id_bytes(self, piece: str) -> bytes:
        if piece in self.ids:
            return array("I", [self.ids[piece]]).tobytes()
        return array("I", [self.byte_ids[bytes([b])] for b in piece.encode()]).tobytes()


def states(pieces: Pieces, text: str, cut: int) -> list[tuple[int, int]]:
    """The states at a cut inside `text`: spans (start, end) of the pieces that cover the character before it, relative to the cut.

    Pieces lie within the word of that character. A cut between two words has one state, (0, 0).
    """
    if cut <= 0 or cut >= len(text) or (text[cut] == MARK and text[cut - 1] != MARK):
        return [(0, 0)]
    low, high = max(0, cut - pieces.longest), min(len(text), cut + pieces.longest)
    for i in range(cut - 1, low, -1):  # the word's begin
        if text[i] == MARK and text[i - 1] != MARK:
            low = i
            break
    for i in range(cut, high):  # and its end
        if text[i] == MARK and text[i - 1] != MARK:
            high = i
            break
    return [(a - cut, b - cut) for a in range(low, cut) for b in range(cut, min(high, a + pieces.longest) + 1) if pieces.alone(text[a:b])]


class _Chunk:
    """A chunk [begin, end) of a marked text with `context` around: forward steps from its begin's states to its end's."""

    def __init__(self, pieces: Pieces, text: str, begin: int, end: int):
        self.pieces, self.text, self.begin, self.end = pieces, text, begin, end
        self.ins, self.outs = states(pieces, text, begin), states(pieces, text, end)
        # Positions between words inside the chunk: all paths pass the first and the last of them.
        cuts = [i for i in range(max(begin, 1), min(end + 1, len(text))) if text[i] == MARK and text[i - 1] != MARK]
        if begin == 0:
            cuts.insert(0, 0)
        if end >= len(text):
            cuts.append(len(text))
        self.first, self.last = (cuts[0], cuts[-1]) if cuts else (None, None)

    def _walk(self, start: tuple[int, int], stop: int) -> dict[tuple[int, int], tuple | None]:
        """States (spans) reached from a span without a begin beyond `stop`, each with the one before it."""
        seen: dict[tuple[int, int], tuple | None] = {start: None}
        todo = [start]
        while todo:
            a, b = span = todo.pop()
            if b >= stop:
                continue
            at_word = a == b or (b < len(self.text) and self.text[b] == MARK and self.text[b - 1] != MARK)
            for e in range(b + 1, min(len(self.text), b + self.pieces.longest) + 1):
                if e > b + 1 and self.text[e - 1] == MARK and self.text[e - 2] != MARK:
                    break
                nxt = (b, e)
                piece = self.text[b:e]
                if nxt not in seen and self.pieces.alone(piece) and (at_word or self.pieces.may_follow(self.text[a:b], piece)):
                    seen[nxt] = span
                    todo.append(nxt)
        return seen

    def _ends(self, seen: dict, stop: int, spans: list[tuple[int, int]]) -> list[bool]:
        """Which states at `stop` are reached."""
        return [(s in seen) if s != (stop, stop) else any(b == stop for _, b in seen) for s in spans]

    def matrix(self) -> np.ndarray:
        """0 where a state at the begin leads to a state at the end, else -inf."""
        ins = [(a + self.begin, b + self.begin) for a, b in self.ins]
        outs = [(a + self.end, b + self.end) for a, b in self.outs]
        if self.first is None:  # one word spans the chunk
            rows = [self._ends(self._walk(s, self.end), self.end, outs) for s in ins]
        else:
            left = [any(b == self.first for _, b in self._walk(s, self.first)) for s in ins]
            right = self._ends(self._walk((self.last, self.last), self.end), self.end, outs)
            rows = [[x and y for y in right] for x in left]
        return np.where(np.array(rows, bool).reshape(len(ins), len(outs)), 0.0, NONE)

    def _path(self, start: tuple[int, int], stop: int, goal: tuple[int, int] | None) -> list[tuple[int, int]]:
        """The spans after `start` on the only path to the goal state (None: to a piece that ends at stop)."""
        if start[1] >= stop:
            return []
        seen = self._walk(start, stop)
        at = goal if goal is not None else next(s for s in seen if s[1] == stop)
        out = []
        while at != start:
            out.append(at)
            at = seen[at]
        return out[::-1]

    def trace(self, i: int, o: int) -> bytes:
        """The ids of the pieces that begin in the chunk, from its i-th to its o-th state.

        Pieces that begin before the chunk belong to an earlier one.
        """
        start = tuple(x + self.begin for x in self.ins[i])
        goal = tuple(x + self.end for x in self.outs[o])
        goal = None if goal == (self.end, self.end) else goal
        spell = lambda spans: b"".join(self.pieces.id_bytes(self.text[a:b]) for a, b in spans)
        if self.first is None:
            return spell(self._path(start, self.end, goal))
        out = spell(self._path(start, self.first, None))
        out += self.pieces.encode_words(_WORDS.findall(self.text[self.first : self.last]))
        if self.last < self.end:
            out += spell(self._path((self.last, self.last), self.end, goal))
        return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return (a[:, :, None] + b[None]).max(axis=1) if a.size and b.size else np.full((a.shape[0], b.shape[1]), NONE)


def whole_product(matrices: list[np.ndarray]) -> np.ndarray:
    """The product of all, neighbours first: products are associative."""
    while len(matrices) > 1:
        matrices = [product(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    return matrices[0]


def boundary_states(matrices: list[np.ndarray], begin: int = 0, end: int | None = None) -> list[int]:
    """The state before each chunk and after the last, on the path of the greatest weight from state `begin` (to state `end`, if given).

    Prefix products by doubling (an associative scan), then the path backwards.
    """
    scan = list(matrices)
    step = 1
    while step < len(scan):
        scan = [scan[i] if i < step else product(scan[i - step], scan[i]) for i in range(len(scan))]
        step *= 2
    start = np.full(matrices[0].shape[0], NONE)
    start[begin] = 0
    ahead = [start, *(m[begin] for m in scan)]
    out = [int(np.argmax(ahead[-1])) if end is None else end]
    for k in range(len(matrices) - 1, -1, -1):
        out.append(int(np.argmax(ahead[k] + matrices[k][:, out[-1]])))
    return out[::-1]


_models: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", *, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, ids binary, n_chunks int): the model's ids of each text, little-endian unsigned 32-bit.

    A null text is an empty one, without ids. Texts of more than `chunk` characters are
    scanned in parallel; rows that repeat an id, and rows without one, are kept apart. A row of the result holds all ids
    of a text, as the row of docs holds all of the text. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    whole = rows.where(F.char_length("text") <= chunk)
    giant = rows.where(F.char_length("text") > chunk)

    def directly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for part in text_slices(batches, "text"):
            ids = [p.encode(t) for t in part.column(1).to_pylist()]
            yield as_batch({"doc_id": part.column(0), "ids": pa.array(ids, pa.binary()), "n_chunks": pa.array([1] * len(ids), pa.int32())})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks with as much text around as states can reach."""
        p = pieces_of(model)
        from pyspark import TaskContext

        n = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = f"{TaskContext.get().partitionId()}-{n}"
                n += 1
                text = p.marked(text)
                around = 2 * p.longest + 2
                at = list(range(0, len(text), chunk))
                low = [max(0, a - around) for a in at]
                yield as_batch({
                    "key": pa.array([f"{doc_id}:{key}"] * len(at)),
                    "doc_id": pa.array([doc_id] * len(at), pa.int64()),
                    "k": pa.array(range(len(at)), pa.int32()),
                    "text": pa.array([text[b : a + chunk + around] for a, b in zip(at, low)]),
                    "begin": pa.array([a - b for a, b in zip(at, low)], pa.int32()),
                    "head": pa.array([b == 0 for b in low]),
                    "tail": pa.array([a + chunk + around >= len(text) for a in at]),
                })

    cut_schema = "key string, doc_id long, k int, text string, begin int, head boolean, tail boolean"
    chunks = written(by_arrow(giant, cut, cut_schema).repartition(partitions(docs.sparkSession), "key", "k"), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for batch in batches:
            found = [_chunk_of(p, r, chunk).matrix() for r in batch.select(["text", "begin", "head", "tail"]).to_pylist()]
            yield as_batch({"key": batch.column(0), "k": batch.column(2), "rows": pa.array([m.shape[0] for m in found], pa.int32()), "m": pa.array([m.astype("<f4").tobytes() for m in found], pa.binary())})

    def held(table: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(m, "<f4").reshape(r, -1).astype(float) for r, m in zip(table.column("rows").to_pylist(), table.column("m").to_pylist())]

    def combine(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        m = whole_product(held(table))
        return pa.table({"key": table.column("key")[:1], "block": table.column("block")[:1], "rows": pa.array([m.shape[0]], pa.int32()), "m": pa.array([m.astype("<f4").tobytes()], pa.binary())})

    def scan(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        path = boundary_states(held(table))
        return pa.table({"key": table.column("key"), "block": table.column("block"), "begin_state": pa.array(path[:-1], pa.int32()), "end_state": pa.array(path[1:], pa.int32())})

    def within(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        path = boundary_states(held(table), table.column("begin_state")[0].as_py(), table.column("end_state")[0].as_py())
        return pa.table({"key": table.column("key"), "k": table.column("k"), "i": pa.array(path[:-1], pa.int32()), "o": pa.array(path[1:], pa.int32())})

    # A row for each chunk of a document: its few states, not its text. Blocks of chunks are combined in parallel, the blocks'
    # products scanned, and the path within each block found between its two states. A text of 2 GB has some 2,000 blocks.
    parts = written(by_arrow(chunks, matrices, "key string, k int, rows int, m binary").withColumn("block", F.floor(F.col("k") / BLOCK).cast("int")), "matrices")
    borders = parts.groupBy("key", "block").applyInArrow(combine, "key string, block int, rows int, m binary").groupBy("key").applyInArrow(scan, "key string, block int, begin_state int, end_state int")
    resolved = parts.join(borders, ["key", "block"]).groupBy("key", "block").applyInArrow(within, "key string, k int, i int, o int")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for batch in batches:
            ids = [_chunk_of(p, r, chunk).trace(r["i"], r["o"]) for r in batch.select(["text", "begin", "head", "tail", "i", "o"]).to_pylist()]
            yield as_batch({"key": batch.column("key"), "doc_id": batch.column("doc_id"), "k": batch.column("k"), "ids": pa.array(ids, pa.binary())})

    traced = by_arrow(chunks.join(resolved, ["key", "k"]).select("key", "doc_id", "k", "text", "begin", "head", "tail", "i", "o"), trace, "key string, doc_id long, k int, ids binary")
    joined = traced.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(1).to_pylist()
            yield as_batch({"doc_id": batch.column(0), "ids": pa.array([b"".join(x) for x in parts], pa.binary()), "n_chunks": pa.array([len(x) for x in parts], pa.int32())})

    schema = "doc_id long, ids binary, n_chunks int"
    return by_arrow(whole, directly, schema).unionByName(by_arrow(joined.select("doc_id", "parts.ids"), join, schema))


def _chunk_of(p: Pieces, row: dict, chunk: int) -> _Chunk:
    return _Chunk(p, row["text"], row["begin"], min(row["begin"] + chunk, len(row["text"])) if row["tail"] else row["begin"] + chunk)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text): the texts of encode_documents()'s ids; bytes that are no UTF-8 become U+FFFD."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for batch in batches:
            yield as_batch({"doc_id": batch.column(0), "text": pa.array([p.decode(np.frombuffer(x, "<u4")).decode(errors="replace") for x in batch.column(1).to_pylist()], pa.string())})

    return by_arrow(encoded.select("doc_id", "ids"), decode, "doc_id long, text string")


def encoded_report(docs: DataFrame, model: str, *, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, n_chars, text_crc32, n_chunks): of each text's ids and of the text decoded from them.

    Nulls, repeated ids, very long texts and empty tables as encode_documents() has them.
    """
    ids = encode_documents(docs, model, chunk=chunk)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for batch in batches:
            own = batch.column(1).to_pylist()
            texts = [p.decode(np.frombuffer(x, "<u4")) for x in own]
            yield as_batch({
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(x) // 4 for x in own], pa.int64()),
                "ids_crc32": pa.array([crc32(x) for x in own], pa.int64()),
                "n_chars": pa.array([len(t.decode(errors="replace")) for t in texts], pa.int64()),
                "text_crc32": pa.array([crc32(t) for t in texts], pa.int64()),
                "n_chunks": batch.column(2),
            })

    return by_arrow(ids, digest, "doc_id long, n_tokens long, ids_crc32 long, n_chars long, text_crc32 long, n_chunks int")
