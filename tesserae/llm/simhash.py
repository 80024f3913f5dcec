"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from . import prefixes as P
from .common import chunks_of, col, forget, get_rows, keep_only, made, make_folder, new_folder, put_rows, table, written
from .components import connected_components
from .words import buffer_spans, joined, mix, quick_hashes

_LANES = np.uint64(0x0101010101010101)


def shingles(text: str, size: int) -> list[bytes]:
    """Runs of so many words (A-Z lower-cased), repeats included; fewer words make one shingle, none make none."""
    words = text.encode().lower().split()
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def fingerprint(text: str, size: int) -> int:
    """64 bits, of which each is set if it is set in over half the shingles' XXH64 (seed 42); as a signed number."""
    got = shingles(text, size)
    if not got:
        return 0
    h = np.fromiter((xxh64_intdigest(s, 42) for s in got), np.uint64, len(got))
    at = np.arange(0, len(h), 255)  # a byte counts up to 255
    ones = np.empty((8, 8), np.int64)  # by byte of the hash and bit of that byte
    for bit in range(8):
        ones[:, bit] = np.add.reduceat((h >> np.uint64(bit)) & _LANES, at).view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return int(np.packbits(ones.ravel() * 2 > len(h), bitorder="little").view("<i8")[0])


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def ball(radius: int) -> list[int]:
    """The masks of all numbers of 64 bits with so many bits set or fewer."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            marks = [fingerprint(x or "", shingle) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64())], ["_id", "_mark"])

    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_mark", T.LongType())])
    return docs.select(col(id_col).alias("_id"), col(text_col).alias("_text")).mapInArrow(make, schema)


def links(marks: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between different fingerprints of the column _mark that differ at radius bits or fewer, enough for the components.

    Every fingerprint emits all variants within half the radius; two within the radius meet on one at least. Those that meet on a
    variant, few as a ball holds few, are linked in their order, and each link is verified.
    """
    if radius % 2:
        raise ValueError("the radius is even, so that all that meet on a variant are within it")
    variants = marks.select("_mark", F.explode(F.array(*[F.col("_mark").bitwiseXOR(F.lit(m)) for m in ball(radius // 2)])).alias("_variant"))
    met = variants.select("_mark", F.lag("_mark").over(Window.partitionBy("_variant").orderBy("_mark")).alias("_other"))
    return met.where("_other is not null").select(F.col("_mark").alias("a"), F.col("_other").alias("b")).distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """Groups documents whose fingerprints are connected by steps of `radius` differing bits or fewer.

    Returns id_col, fingerprint (16 hex digits) and component_id (the smallest id_col that can be reached, its own included), a
    row for each row of docs. A null text counts as empty; texts without words have fingerprint zero and are linked like others;
    repeated rows and equal ids share a component; rows whose id is null are in the components too, and where all ids of one are
    null so is component_id; an empty table gives an empty one. Other columns are ignored. Equal fingerprints are merged before
    anything is emitted, so a group of copies costs as much as one document.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle), "marks")
    marks = written(marked.groupBy("_mark").agg(F.min("_id").alias("_least")), "distinct-marks")
    nodes = connected_components(links(marks.select("_mark"), radius))
    label = F.coalesce("component", "_mark").alias("_label")
    labelled = marks.join(nodes, marks["_mark"] == nodes["node"], "left").select("_mark", "_least", label)
    least = labelled.groupBy("_label").agg(F.min("_least").alias("component_id"))
    named = labelled.join(least, "_label").select(F.col("_mark").alias("_of"), "component_id")
    return marked.join(named, F.col("_mark") == F.col("_of")).select(F.col("_id").alias(id_col), hex64(F.col("_mark")).alias("fingerprint"), "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def one_of_each_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """Of each component that simhash_components() finds the row with the smallest id (null counts as largest).

    The columns of docs. Of rows with one id those of the smallest hash of their text count as first; of rows that are equal in id and text one stays; an empty
    table gives an empty one. Rows are told apart by their id and a hash of their text, so that no texts but those that stay are gathered by a key.
    """
    rank, mark = F.coalesce(col(id_col).cast("long"), F.lit(2**63 - 1)), F.xxhash64(F.coalesce(col(text_col), F.lit("")))
    named = simhash_components(docs.select(F.struct(rank.alias("rank"), mark.alias("mark")).alias("_key"), col(text_col).alias("_text")), "_key", "_text", shingle, radius)
    first = written(named.where(F.col("_key") == F.col("component_id")).select(F.col("_key.rank").alias("_rank"), F.col("_key.mark").alias("_mark")).distinct(), "kept")
    kept = docs.select("*", rank.alias("_rank"), mark.alias("_mark")).join(first, ["_rank", "_mark"], "left_semi")
    once = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_rank", "_mark").orderBy("_rank"))).where("_n = 1")
    return once.select(*map(col, docs.columns))


#: Longs of a text's parities, rows of a shingle that meet in one group before they are dealt over several, bytes of text that are hashed at once, and pairs that one task compares.
PARITIES, RUN, AT_ONCE, COMPARED = 8, 20_000, 2 << 20, 2_000
_POST = np.dtype([("token", "<u8"), ("pair", "<i8"), ("place", "<i4"), ("n", "<i4"), ("pos", "<i4")])
#: What is sent of a shingle's hash: two that agree here meet without need, and are verified.
_SENT = np.uint64(2**48 - 1)
_EPS = 1e-9


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """Of each text 64 bits of hash of its distinct shingles, ascending; shingles are those of shingles()."""
    at = 0
    while at < len(texts):
        raw, held = [], 0
        while at + len(raw) < len(texts) and (not raw or held < AT_ONCE):
            raw.append(texts[at + len(raw)].encode().lower())
            held += len(raw[-1])
        at += len(raw)
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        starts, ends = buffer_spans(data)
        h = quick_hashes(data, starts, ends)
        cuts = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in raw])).tolist()
        for a, b in zip([0, *cuts], cuts, strict=False):
            own = h[a:b]
            k = min(size, len(own))
            whole = own[: len(own) - k + 1]
            for j in range(1, k):
                whole = joined(whole, own[j : len(own) - k + 1 + j], j)
            yield np.unique(mix(whole + np.uint64(k))) if k else own


def parities(h: np.ndarray) -> list[int]:
    """Of how many shingles, odd or even, fall on each of so many bits: two sets differ in at least as many as their parities do in bits."""
    odd = np.bincount((h & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


_ROWS = "chunk long, place int, _u long, _rank long, _n int, _marks array<long>, piece int, slots binary, counts binary"


def _stored(docs: DataFrame, folder: str, shingle: int) -> DataFrame:
    """Writes the rows (_u, _rank, _text, ...) of docs into chunk files, and returns their places, and each task's counts of shingles."""
    at_text = docs.columns.index("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, task = P.Counter(), TaskContext.get().taskAttemptId() << 20
        for i, rows in enumerate(chunks_of(batches, at_text)):
            put_rows(folder, f"{task + i}.arrow", rows)
            size, marks, slots = [], [], [np.zeros(0, np.uint64)]
            for h in shingle_sets(rows["_text"].to_pylist(), shingle):
                size.append(len(h))
                marks.append(parities(h))
                slots.append(h >> np.uint64(64 - P.SLOT_BITS))
            counter.add(np.concatenate(slots))
            n = len(rows)
            columns = [np.full(n, task + i), np.arange(n, dtype=np.int32), rows["_u"].combine_chunks(), rows["_rank"].combine_chunks()]
            own = [pa.array(size, pa.int32()), pa.array(marks, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *own, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names)
        c = counter.rows(task)
        n = c.num_rows
        none = [pa.nulls(n, k) for k in (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([c["part"], *none, c["piece"], c["slots"], c["counts"]], names)

    names = [f.strip().split()[0] for f in _ROWS.split(",")]
    return docs.mapInArrow(run, _ROWS)


def _verified(pairs: DataFrame, folder: str, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b, at ac, ap and bc, bp) whose texts are alike: the one is sent to the other's chunk.

    About COMPARED pairs of a chunk meet in a task; those of a chunk with more are dealt over several.
    """

    def texts(chunk: int) -> pa.ChunkedArray:
        return get_rows(folder, f"{chunk}.arrow")["_text"]

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, now, held = zstandard.ZstdCompressor(level=1).compress, None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, sent = batch.slice(at, 500), []
                for chunk, place in zip(part["ac"].to_pylist(), part["ap"].to_pylist(), strict=True):
                    if chunk != now:
                        now, held = chunk, texts(chunk)
                    sent.append(squeeze(held[place].as_py().encode()))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in ("a", "b", "bc", "bp", "bpart")), pa.array(sent, pa.binary())], ["a", "b", "bc", "bp", "bpart", "sent"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, now, held, own, q = zstandard.ZstdDecompressor().decompress, None, None, None, set()
        for batch in batches:
            same = []
            for chunk, place, sent in zip(batch["bc"].to_pylist(), batch["bp"].to_pylist(), batch["sent"].to_pylist(), strict=True):
                if chunk != now:
                    now, held, own = chunk, texts(chunk), None
                if place != own:
                    own, q = place, set(shingles(held[place].as_py(), shingle))
                p = set(shingles(expand(sent).decode(), shingle))
                same.append(len(p & q) >= least * len(p | q))
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    tasks = max(2 * pairs.sparkSession.sparkContext.defaultParallelism, pairs.count() // COMPARED)
    for chunk, part in (("ac", "apart"), ("bc", "bpart")):
        parts = pairs.groupBy(F.col(chunk).alias("_of")).agg(F.ceil(F.count(F.lit(1)) / COMPARED).alias("_parts"))
        pairs = pairs.join(parts, F.col(chunk) == F.col("_of")).withColumn(part, F.pmod(F.xxhash64("a", "b"), F.col("_parts"))).drop("_of", "_parts")
    fetched = pairs.repartition(tasks, "ac", "apart").sortWithinPartitions("ac", "ap").mapInArrow(ship, "a long, b long, bc long, bp int, bpart long, sent binary")
    return written(fetched.repartition(tasks, "bc", "bpart").sortWithinPartitions("bc", "bp").mapInArrow(compare, "a long, b long"), "links")


def _groups(stored: DataFrame, folder: str, shingle: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(node, component): the groups of different texts, of more than one; and (_u, _rank, chunk, place): of each text the row that stays."""
    spark = stored.sparkSession
    counts = stored.where("piece is not null").select("piece", F.col("chunk").alias("part"), "slots", "counts")
    logs = spark.sparkContext.broadcast(P.frequencies(counts))
    rows = stored.where("_u is not null")
    first = rows.groupBy("_u").agg(F.min(F.struct("_rank", "chunk", "place", "_n", "_marks")).alias("_first")).select("_u", "_first.*")
    firsts = written(first, "different-texts")
    buckets = max(8, firsts.count() // 1000)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, places in zip(batch["chunk"].to_pylist(), batch["places"].to_pylist(), strict=True):
                rows = get_rows(folder, f"{chunk}.arrow").select(["_u", "_text"]).take(pa.array(places))
                size, rare = [], []
                for h in shingle_sets(rows["_text"].to_pylist(), shingle):
                    log = logs.value[(h >> np.uint64(64 - P.SLOT_BITS)).astype(np.int64)]
                    need = len(h) - int(np.ceil(least * len(h) - _EPS)) + 1 if len(h) else 0
                    size.append(len(h))
                    at = np.lexsort((h, log))[:need]
                    rare.append(np.where(log[at] > 0, h[at], np.uint64(0)))  # one that no other text holds keeps its place alone
                each = np.array([len(x) for x in rare], np.int64)
                p = np.zeros(int(each.sum()), _POST)
                p["token"] = np.concatenate([np.zeros(0, np.uint64), *rare])
                p["place"], p["n"] = np.repeat(np.array(places, np.int32), each), np.repeat(np.array(size), each)
                p["pos"] = np.arange(len(p)) - np.repeat(np.cumsum(each) - each, each)
                shared = p["token"] > 0
                p, u = p[shared], np.repeat(rows["_u"].to_numpy(), each)[shared]
                dealt = P.blocks(logs.value[(p["token"] >> np.uint64(64 - P.SLOT_BITS)).astype(np.int64)], RUN)
                p["token"] &= _SENT
                which, pair = P.meetings(u % dealt, dealt)  # a crowded shingle's row goes to each pair of blocks that holds its own
                p = p[which]
                p["pair"] = pair
                if not len(p):  # no text of the chunk shares a shingle of its prefix
                    continue
                to = (mix(p["token"] ^ mix(p["pair"].view(np.uint64) + np.uint64(1))) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                p, to = p[order], to[order]
                at = np.flatnonzero(np.diff(to, prepend=-1))
                sent = [P.planes(p[a:b]) for a, b in zip(at.tolist(), np.append(at[1:], len(p)).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(to[at]), pa.array(np.full(len(at), chunk)), pa.array(sent, pa.binary())], ["_bucket", "_chunk", "_posts"])

    work = firsts.groupBy("chunk").agg(F.sort_array(F.collect_list("place")).alias("places"))
    tasks = max(2 * spark.sparkContext.defaultParallelism, work.count() // 4)
    posts = work.repartition(tasks).mapInArrow(make, "_bucket long, _chunk long, _posts binary")

    def first_pairs(key: tuple, group: pa.Table) -> pa.Table:
        sent = [P.records(x, _POST) for x in group["_posts"].to_pylist()]
        p, chunk = np.concatenate(sent), np.repeat(group["_chunk"].to_numpy(), [len(x) for x in sent])
        order = np.lexsort((p["place"], chunk, p["n"], p["pair"], p["token"]))
        p, chunk = p[order], chunk[order]
        new = np.zeros(len(p), np.int64)
        new[1:] = (p["token"][1:] != p["token"][:-1]) | (p["pair"][1:] != p["pair"][:-1])
        run = np.cumsum(new)
        y, x, more = P.meet(p["n"], p["pos"], run, least, P.KEPT)
        both = np.unique(np.stack([chunk[y], p["place"][y], chunk[x], p["place"][x]], 1), axis=0)
        crowd = np.flatnonzero(np.isin(run, run[more]))  # members of the runs in which some had more
        rest, where = np.zeros(len(both), np.int64), (chunk[crowd], p["place"][crowd].astype(np.int64))
        return pa.table(
            {
                **{name: np.concatenate([both[:, i], where[i % 2]]) for i, name in enumerate(("ac", "ap", "bc", "bp"))}, "_bucket": np.concatenate([rest, np.full(len(crowd), key[0].as_py())]), "_run": np.concatenate([rest - 1, run[crowd]]),
                "_n": np.concatenate([rest, p["n"][crowd]]), "_pos": np.concatenate([rest, p["pos"][crowd]]), "_asks": np.concatenate([rest > 0, more[crowd]]),
            }
        )

    def other_pairs(key: tuple, group: pa.Table) -> pa.Table:
        u, n, pos, label, asks = (group[c].to_numpy() for c in ("u", "_n", "_pos", "_label", "_asks"))
        order = np.lexsort((u, n))
        y, x, _ = P.meet(n[order], pos[order], np.zeros(len(u), np.int64), least, None, group=label[order], asks=asks[order].astype(bool))
        y, x = u[order][y], u[order][x]
        return pa.table({"a": np.maximum(y, x), "b": np.minimum(y, x)})

    def confirmed(pairs: DataFrame) -> DataFrame:
        one, two = (firsts.select(F.col("_u").alias(n), F.col("chunk").alias(n + "c"), F.col("place").alias(n + "p"), F.col("_n").alias(n + "n"), F.col("_marks").alias(n + "m")) for n in ("a", "b"))
        apart = F.aggregate(F.zip_with("am", "bm", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, n: s + n)
        within = (1 + least) * apart <= (1 - least) * (F.col("an") + F.col("bn")) + _EPS
        near = pairs.distinct().join(one, "a").join(two, "b").where(within).select("a", "ac", "ap", "b", "bc", "bp")
        return _verified(written(near, "near-pairs"), folder, shingle, least)

    met = written(posts.groupBy("_bucket").applyInArrow(first_pairs, "ac long, ap long, bc long, bp long, _bucket long, _run long, _n long, _pos long, _asks boolean"), "met")
    logs.destroy()
    one, two = (firsts.select(F.col("chunk").alias(n + "c"), F.col("place").cast("long").alias(n + "p"), F.col("_u").alias("u" + n)) for n in ("a", "b"))
    links_ = confirmed(met.where("_run < 0").select("ac", "ap", "bc", "bp").distinct().join(one, ["ac", "ap"]).join(two, ["bc", "bp"]).where("ua != ub").select(F.greatest("ua", "ub").alias("a"), F.least("ua", "ub").alias("b")))
    groups = connected_components(links_)
    crowds = met.where("_run >= 0").join(one, ["ac", "ap"]).select(F.col("ua").alias("u"), "_bucket", "_run", "_n", "_pos", "_asks")
    if not crowds.isEmpty():
        labelled = crowds.join(groups, F.col("u") == F.col("node"), "left").select("u", "_bucket", "_run", "_n", "_pos", "_asks", F.coalesce("component", "u").alias("_label"))
        others = labelled.groupBy("_bucket", "_run").applyInArrow(other_pairs, "a long, b long")
        groups = connected_components(links_.unionByName(confirmed(others)))
    return groups, firsts


def _keyed(docs: DataFrame, id_col: str | None, text_col: str) -> DataFrame:
    text = F.coalesce(col(text_col), F.lit(""))
    rank = F.coalesce(col(id_col).cast("long"), F.lit(2**63 - 1)) if id_col else F.lit(0).cast("long")
    rest = [F.struct(F.lit(0).alias("_"), *[col(c) for c in docs.columns if c != text_col]).alias("_rest"), col(text_col).isNull().alias("_null")] if id_col else []
    return docs.select(F.xxhash64(text).alias("_u"), rank.alias("_rank"), text.alias("_text"), *rest)


def similar_groups(docs: DataFrame, text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(_text_hash, _group): the groups of texts connected by a Jaccard similarity of the sets of word shingles of `least` or more.

    Exact: of a set's shingles in one order for all, frequent ones last, the first few must hold one of any similar set, so texts meet on
    these. A shingle's rows beyond RUN are dealt over pairs of blocks. Pairs that pass the length and the positional filter and the
    bound from their parities are verified on their shingles. Where a text has many candidates of a shingle it takes a few first; once
    these are verified it meets all others there that are not yet connected with it, so that every pair is connected or rejected.
    How frequent shingles are is counted over all texts. The texts stand in chunk files of the shared folder; one of a pair is shuffled.
    Only groups of more than one text are returned; equal texts share a hash and count once; nulls count as empty.
    """
    folder = new_folder(docs.sparkSession, "text-chunks")
    make_folder(folder)
    groups, _ = _groups(written(_stored(_keyed(docs, None, text_col), folder, shingle), "text-places"), folder, shingle, least)
    return groups.select(F.col("node").alias("_text_hash"), F.col("component").alias("_group"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """Of each group of equal or similar texts the row with the smallest id (null counts as largest), and all other rows.

    The columns of docs, whatever their names. Of rows that are equal in id and text one stays; a null text counts as an empty one and
    stays null where its row does; an empty table gives an empty one.
    """
    spark, before = docs.sparkSession, made()
    folder = new_folder(spark, "text-chunks")
    make_folder(folder)
    keyed = _keyed(docs, id_col, text_col)
    groups, firsts = _groups(written(_stored(keyed, folder, shingle), "text-places"), folder, shingle, least)
    own = firsts.join(groups, F.col("_u") == F.col("node"), "left").withColumn("_group", F.coalesce("component", "_u"))
    best = own.groupBy("_group").agg(F.min(F.struct("_rank", "chunk", "place")).alias("_best")).select("_best.*")
    work = written(best.groupBy("chunk").agg(F.sort_array(F.collect_list("place")).alias("places")), "kept")
    rest = keyed.schema["_rest"]
    forget(before, "text-places", "different-texts", "met", "near-pairs", "links", "edges")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, places in zip(batch["chunk"].to_pylist(), batch["places"].to_pylist(), strict=True):
                rows = get_rows(folder, f"{chunk}.arrow").take(pa.array(places)).combine_chunks()
                text = pc.if_else(rows["_null"], pa.scalar(None, rows["_text"].type), rows["_text"])
                yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (text, rows["_rest"])], ["_text", "_rest"])

    tasks = max(2 * spark.sparkContext.defaultParallelism, work.count() // 4)
    kept = work.repartition(tasks).mapInArrow(read, T.StructType([T.StructField("_text", T.StringType()), rest]))
    return kept.select(*[F.col("_text").alias(c) if c == text_col else F.col("_rest").getField(c).alias(c) for c in docs.columns])
