"""Best-fit packing of documents into sequences by a configuration linear program.

Only the histogram of piece lengths, at most `capacity` numbers, reaches the
driver. There the covering program over configurations (multisets of lengths
that fit a sequence) is solved by multiplicative weights: each step prices
configurations by a knapsack dynamic program over the lengths' weights. The
fractional solution is rounded and the program solved again for what is left,
until few pieces are left. A round takes a share of
the pieces, so the number of different patterns grows with the logarithm of
the input. The n-th piece of each length then finds its place
from the patterns alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corvane.llm.bpememo import ENCODED_BYTES, encoder
from corvane.llm.common import as_batch, by_arrow, partitions, text_slices, written

#: Steps of the multiplicative weights in a round, their rate, the share of a scarce length that a column takes,
#: how far from the best a column's weight may be, and how much more a token weighs in a piece as long as a sequence.
STEPS, RATE, STEP, GAP, BEND = 120, 1.0, 0.5, 0.02, 0.3
#: Lengths for each piece that is left when the rounds end.
REST = 16
#: A round whose fullest columns place a smaller share of the pieces takes its other columns, too.
LITTLE = 0.1


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each row's ids and end_id, cut into pieces of at most capacity.

    The first piece of a longer row may be shorter, the others are full. A null text is an empty one.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_column
        for part in text_slices(batches, "text", ENCODED_BYTES):
            ids, bounds = encode(part.column(1))
            bounds = bounds.tolist()
            rows, piece, start, length, crc = [], [], [], [], []
            for row in range(part.num_rows):
                own = ids[bounds[row] : bounds[row + 1]].tobytes() + end
                n = len(own) // 4
                a, b, k = 0, n % capacity or min(n, capacity), 0
                while a < n:
                    rows.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(crc32(own[4 * a : 4 * b]))
                    a, b, k = b, b + capacity, k + 1
            yield as_batch({"doc_id": part.column(0).take(pa.array(rows, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return by_arrow(rows, cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Prices:
    """An unbounded knapsack over the lengths: the greatest weight that fits each space, and what makes it up.

    A length that a shorter one (or one as long) outweighs can't be part of a best filling and is left out.
    """

    def __init__(self, weight: np.ndarray, lengths: np.ndarray, capacity: int):
        best = np.maximum.accumulate(weight)
        self.first = np.flatnonzero(np.r_[best[0] > 0, best[1:] > best[:-1]])
        size, worth = lengths[self.first], weight[self.first]
        self.value = np.zeros(capacity + 1)
        choice = np.full(capacity + 1, -1, np.int64)
        fitting = np.searchsorted(size, np.arange(capacity + 1), side="right").tolist()
        for c in range(1, capacity + 1):
            self.value[c] = self.value[c - 1]
            if k := fitting[c]:
                gain = self.value[c - size[:k]] + worth[:k]
                j = int(gain.argmax())
                if gain[j] > self.value[c]:
                    self.value[c], choice[c] = gain[j], j
        self.size, self.choice = size.tolist(), choice.tolist()

    def filling(self, space: int) -> dict[int, int]:
        """{index of length: copies} of the best filling of a space."""
        out: dict[int, int] = {}
        while space > 0:
            j = self.choice[space]
            if j < 0:
                space -= 1
                continue
            i = int(self.first[j])
            out[i] = out.get(i, 0) + 1
            space -= self.size[j]
        return out


def _best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins by best fit of the lengths, largest first."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0  # bit s is set while a bin with s free tokens exists
    bins: list[list[int]] = []
    for n in sorted(lengths, reverse=True):
        fitting = spaces >> n
        if fitting:
            space = n + (fitting & -fitting).bit_length() - 1
            at = free[space].pop()
            if not free[space]:
                spaces &= ~(1 << space)
        else:
            space, at = capacity, len(bins)
            bins.append([])
        bins[at].append(n)
        if space > n:
            free[space - n].append(at)
            spaces |= 1 << (space - n)
    return bins


def _weighted_columns(lengths: np.ndarray, left: np.ndarray, capacity: int, steps: int) -> dict[tuple, float]:
    """A fractional solution {configuration: sequences} of the covering program, by multiplicative weights.

    A length weighs its tokens, a little more the longer it is (BEND), times exp(-RATE * share of it that is covered).
    Each step prices all fillings at once. Every length that still lags behind the step's goal takes, longest first, the best configuration with it,
    if that is within GAP of the best of all; while a long length lags for want of fillings, no configuration
    of short ones alone is taken. Nothing is covered twice.
    """
    columns: dict[tuple, float] = {}
    cover, worth = np.zeros(len(lengths)), lengths * (1 + BEND * lengths / capacity)
    for step in range(1, steps + 1):
        weight = np.where(cover < 0.999 * left, worth * np.exp(-RATE * cover / left), 0)
        if not weight.any():
            break
        prices = _Prices(weight, lengths, capacity)
        gain = np.where(weight > 0, weight + prices.value[capacity - lengths], 0)
        lags = False
        for i in np.flatnonzero(gain >= (1 - GAP) * prices.value[capacity])[::-1].tolist():
            if lags and 2 * lengths[i] < capacity:
                break
            missing = left[i] * step / steps - cover[i]
            if missing <= 0:
                continue
            chosen = prices.filling(capacity - int(lengths[i]))
            chosen[i] = chosen.get(i, 0) + 1
            key = tuple(sorted((j, min(n, int(left[j]))) for j, n in chosen.items()))
            wanted = missing / dict(key)[i]
            each = min(wanted, *(STEP * (left[j] - cover[j]) / n for j, n in key))
            lags |= each < 0.999 * wanted
            if each > 1e-9:
                columns[key] = columns.get(key, 0) + each
                for j, n in key:
                    cover[j] += n * each
    return columns


def configurations(histogram: dict[int, int], capacity: int, steps: int = STEPS) -> list[tuple[int, dict[int, int]]]:
    """[(number of sequences, {length: copies in each})]: exactly the pieces of the histogram, none over capacity."""
    return [(times, dict(pattern)) for part in solved(histogram, capacity, steps) for pattern, times in part.items()]


def solved(histogram: dict[int, int], capacity: int, steps: int = STEPS) -> list[dict[tuple, int]]:
    """{configuration: sequences} of pieces that nothing fits beside, of the program, and of the tail.

    A round solves the program for the pieces left and rounds it: its fullest columns are taken as
    often as the whole part of their share says, then once more where the pieces
    allow it, those with the longest length first. A round in which the fullest columns place little takes all
    columns. Rounds go on until no packing can need fewer sequences, or few pieces are left beside the lengths there were (one for REST of them). The tail is what is left after the round that
    gives the fewest sequences in all, of several the last; it is packed best-fit decreasing. Only rounds that leave
    at most twice as many pieces as there were lengths come into question, thus at most 2 * capacity whatever the input.
    """
    shortest = min(histogram, default=0)
    lone = {((n, 1),): histogram[n] for n in histogram if n + shortest > capacity}
    patterns: dict[tuple, int] = {}
    lengths = np.array(sorted(n for n in histogram if n + shortest <= capacity), np.int64)
    left = np.array([histogram[int(n)] for n in lengths], np.int64)
    tail = len(lengths)

    def take(key: tuple, times: int) -> None:
        times = min(times, *(int(left[i]) // n for i, n in key))
        if times > 0:
            pattern = tuple((int(lengths[i]), n) for i, n in key)
            patterns[pattern] = patterns.get(pattern, 0) + times
            for i, n in key:
                left[i] -= times * n

    best: list[dict[tuple, int]] = [lone]
    fewest, least = None, -(-int((lengths * left).sum()) // capacity)  # no packing needs fewer than the tokens fill
    while before := int(left.sum()):
        lengths, left = lengths[left > 0], left[left > 0]
        columns = _weighted_columns(lengths, left, capacity, steps)
        full = {key: sum(int(lengths[i]) * n for i, n in key) for key in columns}
        most = max(full.values())
        for chosen in ([k for k in columns if full[k] == most], list(columns)):
            for key in sorted(chosen, key=lambda k: (-columns[k], k)):
                take(key, int(columns[key]))
            for key in sorted(chosen, key=lambda k: (-k[-1][0], k)):
                take(key, 1)
            if before - int(left.sum()) >= LITTLE * before:
                break
        after = int(left.sum())
        if after <= 2 * tail:
            rest: dict[tuple, int] = {}
            for own in _best_fit([int(n) for n, m in zip(lengths, left) for _ in range(int(m))], capacity):
                pattern = tuple(sorted((n, own.count(n)) for n in set(own)))
                rest[pattern] = rest.get(pattern, 0) + 1
            total = sum(patterns.values()) + sum(rest.values())
            if fewest is None or total <= fewest:
                fewest, best = total, [lone, dict(patterns), rest]
        if REST * after <= tail or fewest == least:
            break
    return best


def pack(pieces: DataFrame, *, capacity: int = 2048, steps: int = STEPS) -> DataFrame:
    """pieces (with doc_id, piece, start, length, ids_crc32) with sequence_id and offset (long), other columns as they are.

    Each sequence holds at most capacity tokens, without gaps from offset 0. An
    empty table gives no rows; null ids are packed as any other. Equal rows are interchangeable: each gets a place of its own.
    """
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    patterns = configurations(counts, capacity, steps)

    # A slot range: pieces of one length with ranks from `low` lie in the sequences of one pattern.
    rows, seen, first = [], dict.fromkeys(counts, 0), 0
    for times, pattern in patterns:
        offset = 0
        for n in sorted(pattern, reverse=True):
            rows.append((n, seen[n], pattern[n], first, offset))
            seen[n] += times * pattern[n]
            offset += n * pattern[n]
        first += times
    assert seen == counts
    slots = spark.sparkContext.broadcast(np.array(sorted(rows), np.int64).reshape(-1, 5).T.copy())  # 40 bytes for each length of each pattern

    # Ranks within a length, in two steps: no task gets all pieces of a length.
    taken = {c.lower() for c in pieces.columns}
    deal, own, before, rank = (_free(name, taken) for name in ("deal", "own", "before", "rank"))
    dealt = pieces.withColumn(deal, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(partitions(spark))).cast("int"))
    sizes = dealt.groupBy("length", deal).agg(F.count("*").alias("n"))
    earlier = sizes.withColumn(before, F.sum("n").over(Window.partitionBy("length").orderBy(deal)) - F.col("n")).drop("n")
    number = F.row_number().over(Window.partitionBy("length", deal).orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = dealt.withColumn(own, number).join(earlier, ["length", deal]).withColumn(rank, F.col(own) + F.col(before))
    return _placed(ranked.select(*[F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")], rank), rank, slots)


def _free(name: str, taken: set[str]) -> str:
    """A column name that isn't taken."""
    while name in taken:
        name += "_"
    taken.add(name)
    return name


def _placed(ranked: DataFrame, rank: str, slots) -> DataFrame:  # noqa: ANN001
    """The place of each rank: in the last slot range of its length that begins at or before it."""
    schema = StructType([*(f for f in ranked.schema.fields if f.name != rank), StructField("sequence_id", LongType()), StructField("offset", LongType())])
    names = ranked.columns
    at_length, at_rank = names.index("length"), names.index(rank)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, low, copies, first, at = slots.value
        borders = np.flatnonzero(np.r_[True, length[1:] != length[:-1]]) if len(length) else np.zeros(0, np.int64)
        for batch in batches:
            n, k = batch.column(at_length).to_numpy(), batch.column(at_rank).to_numpy()
            slot = np.zeros(len(n), np.int64)
            order = np.argsort(n, kind="stable")
            edge = np.flatnonzero(np.r_[True, n[order][1:] != n[order][:-1]]) if len(n) else []
            for a, b in zip(edge, [*edge[1:], len(n)]):
                i = int(np.searchsorted(length[borders], n[order[a]]))
                begin, end = borders[i], borders[i + 1] if i + 1 < len(borders) else len(length)
                slot[order[a:b]] = begin + np.searchsorted(low[begin:end], k[order[a:b]], side="right") - 1
            within = k - low[slot] if len(n) else k
            columns = {c: batch.column(j) for j, c in enumerate(names) if c != rank}
            sequence = first[slot] + within // copies[slot] if len(n) else k
            offset = at[slot] + within % copies[slot] * n if len(n) else k
            yield as_batch(columns | {"sequence_id": pa.array(sequence.astype(np.int64)), "offset": pa.array(offset.astype(np.int64))})

    return by_arrow(ranked, place, schema)


def packed_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, steps: int = STEPS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs(doc_id, text).

    A null or empty text is its end_id alone; rows that repeat an id, and rows without one, are documents of
    their own. A very long text is cut into pieces of capacity. An empty table gives no rows; other columns are not read.
    """
    out = pack(token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id), capacity=capacity, steps=steps)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
