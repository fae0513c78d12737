"""N-gram Jaccard join by signature trees: near-duplicate classes of whole texts.

The join is exact (up to equal 64-bit hashes of different shingles):

1. Texts with the same shingle set form a class; the smallest id stands for it.
2. Shingles are ordered, frequent ones last, others by hash. Two sets of
   similarity t share a shingle among the first n - ceil(t n) + 1 of each, and
   the smaller one has it among its first n - ceil(2 t n / (1 + t)) + 1.
3. A block is the classes that have a shingle there. Each class is first
   compared with the smallest class of two of its blocks; the components so
   found are collapsed. Blocks that lie in one component need no more work,
   and of blocks with the same members one is kept.
4. In each block that is left, a dual traversal of signature trees gives the
   pairs from different components that can be similar. Large blocks are dealt
   out as pairs of bounded chunks. The pairs are verified on the whole sets.

Exact copies cost one row each, a large group of near copies costs a link or
two a member, and no pair within a component is looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import sigtree
from corvane.llm.common import as_batch, by_arrow, dropped, freed, spread_join, text_slices, written
from corvane.llm.components import components
from corvane.llm.textnum import mix, shingle_sets

#: A shingle is frequent if one task finds it in this share of its documents; at most FREQUENT are kept.
FREQUENT_SHARE, FREQUENT = 0.002, 200_000
#: Members of a block that one task compares at once.
CHUNK = 2048
#: Bits of the Bloom filter over the ids whose sets are needed again: 1 MB, whatever the input.
BLOOM_BITS = 1 << 23


def _frequent(docs: DataFrame, id_col: str, text_col: str, width: int) -> np.ndarray:
    """Shingles in many documents, sorted. They only order the shingles; any list gives the same result."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        held: list[np.ndarray] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([keys, *held])
            weight = np.concatenate([counts, np.ones(len(every) - len(keys), np.int64)])
            order = np.argsort(every, kind="stable")
            every, weight = every[order], weight[order]
            at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
            return every[at], np.add.reduceat(weight, at) if len(at) else weight

        for part in text_slices(batches, text_col):
            sets = shingle_sets(part.column(0), width)
            held += sets
            rows += len(sets)
            size += sum(map(len, sets))
            if size > 1_000_000:
                keys, counts = merged()
                held, size = [], 0
                often = counts >= max(2, FREQUENT_SHARE * rows / 4)  # as in lossy counting, rare ones are forgotten
                keys, counts = keys[often], counts[often]
        keys, counts = merged()
        often = counts >= max(8, FREQUENT_SHARE * rows)
        yield as_batch({"token": pa.array(keys[often].view(np.int64)), "n": pa.array(counts[often])})

    found = by_arrow(docs.select(text_col), count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()
    return np.sort(top["token"].to_numpy(np.int64).view(np.uint64))


def _ordered_prefix(tokens: np.ndarray, frequent: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """The first tokens in the common order that any partner must share, and how many of them a smaller set needs."""
    n = len(tokens)
    probe = n - -(-num * n // den) + 1
    index = n - -(-2 * num * n // (num + den)) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
        rare = tokens[~often]
        return (rare[:probe] if len(rare) >= probe else np.r_[rare, tokens[often]][:probe]), index
    return tokens[:probe], index


def _bloom(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of two hashes over ids(id), as a bit array of BLOOM_BITS."""
    spots = ids.select(F.explode(F.array(*[_spot(F.col("id"), k) for k in (1, 2)])).alias("x")).distinct()
    maps = spots.groupBy(F.expr("bitmap_bucket_number(x)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(x))").alias("bits")).collect()
    out = np.zeros(BLOOM_BITS // 8 + 8192, np.uint8)
    for r in maps:  # at most BLOOM_BITS / 32768 + 1 rows of 4 KB
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _spot(x: Column, k: int) -> Column:
    """The k-th Bloom position counted from 1; _spots() counts from 0."""
    return F.conv(F.substring(F.sha2(F.concat(x.cast("string"), F.lit(f":{k}")), 256), 1, 6), 16, 10).cast("long") % BLOOM_BITS + 1


def _spots(x: int, k: int) -> int:
    import hashlib

    return int(hashlib.sha256(f"{x}:{k}".encode()).hexdigest()[:6], 16) % BLOOM_BITS


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id long, n_shingles long, component_id long), a row for each row of docs with an id.

    A-Z are lower-cased; a set is the distinct shingles of `words` words, or the
    whole sequence if it is shorter. Two rows link when den * |intersection| >=
    num * |union|. component_id is the smallest id reachable by links. Null and
    empty texts have no shingles and no links. Rows with a null id are left
    out; rows that repeat an id count as texts of that id, which is then linked with the
    links of each. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    frequent = spark.sparkContext.broadcast(_frequent(docs, "doc_id", "text", words))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            sets = shingle_sets(part.column(1), words)
            keys, index, one, two = [], [], [], []
            for s in sets:
                k, i = _ordered_prefix(s, frequent.value, num, den) if len(s) else (s, 0)
                keys.append(k)
                index.append(i)
                one.append(s.sum(dtype=np.uint64))
                two.append(mix(s).sum(dtype=np.uint64))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield as_batch({
                "doc_id": part.column(0),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "one": pa.array(np.array(one, np.uint64).view(np.int64)),
                "two": pa.array(np.array(two, np.uint64).view(np.int64)),
                "n_index": pa.array(index, pa.int32()),
                "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                "bits": pa.array([sigtree.bitmap(s, sigtree.width_for(len(s))).tobytes() for s in sets], pa.binary()),
            })

    sets = written(by_arrow(docs, prefixes, "doc_id long, n long, one long, two long, n_index int, keys array<long>, bits binary"), "sets")
    copies = written(sets.where("n > 0").groupBy("n", "one", "two").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "copies")
    same = copies.drop("copies")
    keyed = ["size", "one", "two"]
    together = spread_join(sets.select("doc_id", F.col("n").alias("size"), "one", "two"), same.withColumnRenamed("n", "size"), keyed, copies.select(F.col("n").alias("size"), "one", "two", F.col("copies").alias("n")))
    member = written(together.select("doc_id", F.col("size").alias("n"), F.coalesce("rep", "doc_id").alias("rep")), "members")

    # The blocks: (token, rep) of the shingles that at least two classes have, one of them among its first.
    heads = sets.join(same.withColumnRenamed("rep", "doc_id"), ["n", "one", "two", "doc_id"], "left_semi")
    keys = heads.select(F.col("doc_id").alias("rep"), "n", "n_index", F.posexplode("keys").alias("pos", "token")).select("token", "rep", F.col("n").cast("int"), "pos", (F.col("pos") < F.col("n_index")).alias("index"))
    tokens = keys.groupBy("token").agg(F.count("*").alias("members"), F.max("index").alias("any_index"), F.min("rep").alias("leader")).where("members > 1 and any_index").drop("any_index")
    blocks = written(keys.join(tokens, "token"), "blocks")
    signed = written(heads.select(F.col("doc_id").alias("rep"), F.col("n").cast("int"), "bits").join(blocks.select("rep").distinct(), "rep", "left_semi"), "signatures")
    dropped(sets)
    freed(spark)

    def possible(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that their bitmaps allow."""

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = (batch.column(c).to_pylist() for c in (3, 5))
                most = np.array([sigtree.most_shared(*v) for v in zip(batch.column(2).to_pylist(), x, batch.column(4).to_pylist(), y)], np.int64)
                least = sigtree.needed(batch.column(2).to_numpy().astype(np.int64), batch.column(4).to_numpy().astype(np.int64), num, den)
                yield batch.select(["a", "b"]).filter(pa.array(most >= least))

        both = pairs.join(signed.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a")), "a").join(signed.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b")), "b")
        alike = (den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")) & (F.col("a") != F.col("b"))
        return by_arrow(both.where(alike).select("a", "b", "n_a", "bits_a", "n_b", "bits_b"), keep, "a long, b long")

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar enough. Sets are made anew, of the texts that the pairs need."""
        pairs = written(pairs, "pairs")
        bloom = spark.sparkContext.broadcast(_bloom(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()))

        def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = bloom.value
            for batch in batches:
                spots = [(_spots(x, 1), _spots(x, 2)) for x in batch.column(0).to_pylist()]
                batch = batch.filter(pa.array([bool(bits[a >> 3] >> (a & 7) & 1 and bits[b >> 3] >> (b & 7) & 1) for a, b in spots], pa.bool_()))
                for part in text_slices([batch], "text") if batch.num_rows else ():
                    found = shingle_sets(part.column(1), words)
                    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                    flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
                    yield as_batch({"rep": part.column(0), "tokens": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))})

        held = written(by_arrow(docs, whole_sets, "rep long, tokens array<long>"), "held")
        left = held.select(F.col("rep").alias("a"), F.col("tokens").alias("x"))
        right = held.select(F.col("rep").alias("b"), F.col("tokens").alias("y"))
        both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
        out = written(both.where(den * F.col("common") >= num * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b"), "links")
        dropped(held)
        dropped(pairs)
        freed(spark)
        return out

    # Links with the smallest class of two blocks of each class: of its first shingle and of its last.
    near = blocks.where("rep <> leader").groupBy("rep").agg(F.min(F.struct("pos", "leader")).alias("p"), F.max(F.struct("pos", "leader")).alias("q"))
    pairs = near.select(F.explode(F.array("p.leader", "q.leader")).alias("a"), F.col("rep").alias("b")).distinct()
    links = linked(possible(pairs))
    early = components(links)

    # What is left: blocks with members of different components.
    placed = blocks.join(early, blocks.rep == early.node, "left").select("token", "rep", "n", "index", F.coalesce("component", "rep").alias("component"))
    mixed = (
        placed.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"), F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("print"), F.min("rep").alias("leader"), F.max("rep").alias("last"))
        .where("low <> high")
        .groupBy("members", "print", "leader", "last")
        .agg(F.min("token").alias("token"))
        .select("token", F.col("leader").alias("first"), "members", F.ceil(F.col("members") / CHUNK).cast("int").alias("chunks"))
    )
    # Near copies meet in many blocks that begin with the same class: a task takes those together and gives a pair once.
    loads = mixed.groupBy("first").agg(F.ceil(F.sum(F.col("members") * F.col("chunks")) / (2 * CHUNK)).cast("int").alias("parts"))
    mixed = mixed.join(loads, "first").select("token", "first", "chunks", F.pmod(F.xxhash64("token"), F.col("parts")).cast("int").alias("part"))
    rows = placed.join(mixed, "token").join(signed.select("rep", "bits"), "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("first", "part", "token", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "own", "rep", "n", "component", "bits")

    def traverse(table: pa.Table) -> pa.Table:
        table = table.sort_by("token")
        token = table.column("token").to_numpy()
        at = np.r_[0, np.flatnonzero(token[1:] != token[:-1]) + 1, len(token)].tolist()
        found = np.concatenate([_block_pairs(table.slice(a, b - a), num, den) for a, b in zip(at[:-1], at[1:])])
        found = np.unique(found, axis=0)
        del table
        return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})

    pairs = rows.groupBy("first", "part", "c1", "c2").applyInArrow(traverse, "a long, b long").distinct()
    more = linked(pairs)
    dropped(blocks)
    dropped(signed)
    whole = components(links.union(more))
    out = member.join(whole, member.rep == whole.node, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    return out


def _block_pairs(table: pa.Table, num: int, den: int) -> np.ndarray:
    """[pair, smaller and larger id]: pairs of a block (or of two chunks of one) from different components that can be similar.

    Sets are joined with those of the same bitmap width and of each larger width
    whose smallest sets can be similar enough (from 1/2 up only twice the width),
    folded, so that no bitmap gets too full to prune.
    """
    side = table.column("own").to_numpy() == table.column("c1")[0].as_py()
    whole = table.column("c1")[0].as_py() == table.column("c2")[0].as_py()
    rep, n, component = (table.column(c).to_numpy().astype(np.int64) for c in ("rep", "n", "component"))
    bits = [np.frombuffer(b, np.uint64) for b in table.column("bits").to_pylist()]
    width = np.array([64 * len(b) for b in bits])
    order = np.lexsort((rep, component, n))
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def tree(at: np.ndarray, w: int) -> sigtree.SignatureTree:
        return sigtree.SignatureTree(np.stack([bits[i] if len(bits[i]) * 64 == w else sigtree.folded(bits[i], w) for i in at]), n[at], component[at])

    def join(x: np.ndarray, y: np.ndarray | None, w: int) -> None:
        if len(x) and (y is None or len(y)):
            i, j = sigtree.dual_join(tree(x, w), None if y is None else tree(y, w), num, den)
            out.append((rep[x[i]], rep[(x if y is None else y)[j]]))

    widths = np.unique(width).tolist()
    for w in widths:
        same = order[width[order] == w]
        if whole:
            join(same, None, w)
        else:
            join(same[side[same]], same[~side[same]], w)
        for wider in (v for v in widths if v > w):
            more = order[width[order] == wider]
            if den * n[same].max() < num * n[more].min():
                continue
            if whole:
                join(same, more, w)
            else:
                join(same[side[same]], more[~side[more]], w)
                join(same[~side[same]], more[side[more]], w)
    a, b = (np.concatenate([p[k] for p in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
    return np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)


def near_duplicate_stage(docs: DataFrame, **options) -> DataFrame:
    """docs without the near copies: of each class the row with the smallest doc_id stays.

    Rows with a null doc_id stay, and so do rows without words.
    """
    classes = jaccard_classes(docs, **options)
    gone = classes.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def _row_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that tells all rows apart, and its name: the doc_id, where no id is null or repeated.

    Else the first row of an id keeps it as its key, and the other rows, and
    those without one, get keys over all ids. Rows get their numbers when they are written.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("rows"))
    odd = ids.where("doc_id is null or rows > 1").select("doc_id")
    if odd.isEmpty():
        return docs, "doc_id"
    key, number = _free(docs, "row_key"), _free(docs, "row_number")
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    firsts = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(number).alias(number)).select(number, F.lit(True).alias(key))
    top = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0] or 0
    keyed = rows.join(firsts, number, "left").withColumn(key, F.when(F.col(key), F.col("doc_id").cast("long")).otherwise(F.lit(max(top, 0) + 1) + F.col(number)))
    out = written(keyed.drop(number), "keyed")
    dropped(rows)
    return out, key


def _free(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class of near copies: that with the smallest doc_id, null last.

    Unlike near_duplicate_stage, rows that repeat an id and rows with a null id are
    rows of their own, so of them too one stays. Of rows with the same smallest id the first stays.
    Rows without words stay.
    """
    keyed, key = _row_keys(docs)
    classes = jaccard_classes(keyed, id_col=key, **options)
    gone = classes.where("component_id <> doc_id").select(F.col("doc_id").alias(key))
    return keyed.join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
