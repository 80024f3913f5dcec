"""Line deduplication by an exact set-similarity join."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import prefixes as P
from . import words as W
from .common import chunks_of, col, forget, get_rows, keep_only, made, make_folder, new_folder, put_rows, table, written

#: Similarity from which two lines are alike, and rows of a token that meet in one group before they are dealt over several.
LEAST, RUN = 0.8, 20_000
#: Rows that a task gathers before it sends them, and pairs that one task compares.
SENT, COMPARED = 1 << 20, 4_000
#: Lines of a buffer that are numbered at once.
_LINES = 1 << 24
_LOW, _TOKEN = np.uint64(2**32 - 1), np.uint64(2**40 - 1)


class Buffer:
    """The texts of a chunk, each followed by a newline, so that every line ends with one."""

    def __init__(self, texts: pa.ChunkedArray):
        whole = pc.binary_join_element_wise(texts.combine_chunks(), "", "\n")
        ends = np.frombuffer(whole.buffers()[1], np.int32, len(whole) + 1).astype(np.int64)
        self.data = np.frombuffer(whole.buffers()[2], np.uint8, ends[-1])
        self.newline = np.flatnonzero(self.data == 10)
        #: The number of each document's first line; and the end.
        self.first = np.searchsorted(self.newline, ends)

    def line(self, i: int) -> bytes:
        return self.data[int(self.newline[i - 1]) + 1 if i else 0 : int(self.newline[i])].tobytes()

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """(line, token): the words of each line, each once in a line, by 40 bits of their hash; ascending."""
        starts, ends = W.buffer_spans(self.data)
        each = np.diff(np.searchsorted(starts, self.newline), prepend=0)
        line, token = _in_order(np.repeat(np.arange(len(each)), each), W.quick_hashes(self.data, starts, ends) >> np.uint64(24))
        fresh = np.ones(len(line), bool)
        fresh[1:] = (line[1:] != line[:-1]) | (token[1:] != token[:-1])
        return line[fresh], token[fresh]

    def sets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places, k1, k2, tokens): the lines with words; the keys of their word sets, of two hashes of whole words, which do not share a bit; and the tokens of all lines."""
        starts, ends = W.buffer_spans(self.data)
        each = np.diff(np.searchsorted(starts, self.newline), prepend=0)
        line = np.repeat(np.arange(len(each)), each)
        h, g = (W.quick_hashes(self.data, starts, ends, other) for other in (False, True))
        order = np.concatenate([np.zeros(0, np.int64), *(a + np.argsort(((line[a:b] - base).astype(np.uint64) << np.uint64(40)) | (h[a:b] >> np.uint64(24))) for base in range(0, len(each), _LINES) for a, b in [np.searchsorted(line, (base, base + _LINES))])])
        h, g = h[order], g[order]
        new = np.ones(len(line), bool)
        new[1:] = line[1:] != line[:-1]
        fresh = new.copy()
        fresh[1:] |= (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        counted = new.copy()
        counted[1:] |= h[1:] >> np.uint64(24) != h[:-1] >> np.uint64(24)
        at, _ = _runs(line[fresh])
        k1, k2 = (np.add.reduceat(W.mix(x[fresh] ^ np.uint64(s << 40)), at).view(np.int64) if len(at) else np.zeros(0, np.int64) for x, s in ((h, 0x51ED27), (g, 0xA5A5A5)))
        return line[fresh][at], k1, k2, h[counted] >> np.uint64(24)


def _in_order(line: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the codes of 40 bits within each line; lines ascend."""
    out = [(line[:0], code[:0])]
    for base in range(0, int(line[-1]) + 1 if len(line) else 0, _LINES):
        a, b = np.searchsorted(line, (base, base + _LINES))
        key = ((line[a:b] - base).astype(np.uint64) << np.uint64(40)) | code[a:b]
        key.sort()
        out.append(((key >> np.uint64(40)).astype(np.int64) + base, key & _TOKEN))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def prefix(n: np.ndarray) -> np.ndarray:
    """How many of a set's n rarest tokens must hold one of any set of similarity 4/5 or more: all but the least overlap, and one."""
    return np.where(n >= 4, n - (4 * n + 4) // 5 + 1, 0)


def _runs(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each line's tokens begin, and how many there are."""
    at = np.flatnonzero(np.diff(line, prepend=-1))
    return at, np.diff(at, append=len(line))


_STORED = pa.schema([("chunk", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("id", pa.int64()), ("tie", pa.int32()), ("place", pa.int32()), ("gone", pa.binary()), ("size", pa.int64()), ("piece", pa.int32()), ("slots", pa.binary()), ("counts", pa.binary())])
_STORED_SQL = "chunk long, k1 long, k2 long, id long, tie int, place int, gone binary, size long, piece int, slots binary, counts binary"


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _STORED], schema=_STORED)


def _stored(docs: DataFrame, folder: str) -> DataFrame:
    """Writes the rows (_id, _tie, _text, ...) of docs into chunk files, each in order; and returns a row for each chunk, with its lines

    that repeat an earlier set of it; rows of its different sets; and the counts of a task's tokens.
    """
    at_text = docs.columns.index("_text")

    def put(rows: pa.Table, chunk: int, counter: P.Counter) -> Iterator[pa.RecordBatch]:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("_id", "ascending"), ("_tie", "ascending")], null_placement="at_start"))
        put_rows(folder, f"{chunk}.arrow", rows)
        buffer = Buffer(rows["_text"])
        place, k1, k2, token = buffer.sets()
        counter.add(token >> np.uint64(40 - P.SLOT_BITS))
        order = np.lexsort((place, k2, k1))
        again = np.zeros(len(place), bool)
        again[order[1:]] = (k1[order[1:]] == k1[order[:-1]]) & (k2[order[1:]] == k2[order[:-1]])
        yield _rows(1, chunk=[chunk], gone=[place[again].astype("<u4").tobytes()], size=[len(buffer.data)])
        doc = pa.array(np.searchsorted(buffer.first, place[~again], "right") - 1)
        ident, tie = (rows[c].combine_chunks().take(doc) for c in ("_id", "_tie"))
        yield _rows(len(doc), chunk=np.full(len(doc), chunk), k1=k1[~again], k2=k2[~again], id=ident, tie=tie, place=place[~again])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        counter, task = P.Counter(), TaskContext.get().taskAttemptId() << 20
        for i, rows in enumerate(chunks_of(batches, at_text)):
            yield from put(rows, task + i, counter)
        counts = counter.rows(task)
        yield _rows(counts.num_rows, chunk=counts["part"], piece=counts["piece"], slots=counts["slots"], counts=counts["counts"])

    return docs.mapInArrow(run, _STORED_SQL)


_POST = np.dtype([("code", "<u8"), ("pair", "<u4"), ("id", "<i8"), ("tie", "<i4"), ("chunk", "<i8"), ("place", "<i4"), ("n", "<i4"), ("pos", "<i4"), ("s1", "<u8"), ("s2", "<u8")])
_MET = ["yc", "yp", "xc", "xp", "apart", "bucket", "run", "id", "tie", "n", "pos", "s1", "s2", "asks"]
_MET_SQL = "yc long, yp int, xc long, xp int, apart int, bucket long, run long, id long, tie int, n int, pos int, s1 long, s2 long, asks boolean"


def _postings(buffer: Buffer, drop: np.ndarray, logs: np.ndarray, chunk: int, ids: pa.Array, ties: pa.Array) -> np.ndarray:
    """The prefixes of the chunk's lines but those to drop, without tokens of one line alone."""
    line, token = buffer.tokens()
    line, code = _in_order(line, (logs[(token >> np.uint64(40 - P.SLOT_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(32)) | (token & _LOW))
    at, n = _runs(line)
    s1, s2 = (np.bitwise_xor.reduceat(np.where((code >> np.uint64(6)) & np.uint64(1) == b, np.uint64(1) << (code & np.uint64(63)), np.uint64(0)), at) if len(at) else np.zeros(0, np.uint64) for b in (0, 1))
    place = line[at]
    kept = ~np.isin(place, drop, assume_unique=True)
    of = np.repeat(np.arange(len(at)), n)
    pos = np.arange(len(line)) - at[of]
    take = np.flatnonzero(kept[of] & (pos < prefix(n)[of]) & (code >> np.uint64(32) > 0))
    of = of[take]
    p = np.zeros(len(take), _POST)
    doc = np.searchsorted(buffer.first, place, "right") - 1
    p["code"], p["pos"], p["chunk"], p["place"], p["n"], p["s1"], p["s2"] = code[take], pos[take], chunk, place[of], n[of], s1[of], s2[of]
    p["id"], p["tie"] = ids.to_numpy(zero_copy_only=False)[doc[of]], ties.to_numpy(zero_copy_only=False)[doc[of]]
    dealt = P.blocks(code[take] >> np.uint64(32), RUN)
    which, pair = P.meetings((W.mix(p["chunk"].astype(np.uint64) ^ (p["place"].astype(np.uint64) << np.uint64(32))) % dealt.astype(np.uint64)).astype(np.int64), dealt)
    p = p[which]
    p["pair"] = pair
    return p


def _sent(found: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    p = np.concatenate(found)
    to = (W.mix(p["code"] ^ W.mix(p["pair"].astype(np.uint64) + np.uint64(1))) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    p, to = p[order], to[order]
    at = np.flatnonzero(np.diff(to, prepend=-1))
    return pa.RecordBatch.from_arrays([pa.array(to[at]), pa.array([P.planes(p[a:b]) for a, b in zip(at.tolist(), np.append(at[1:], len(p)).tolist(), strict=True)], pa.binary())], ["_bucket", "_posts"])


def _met(key: tuple, group: pa.Table) -> pa.Table:
    """The candidate pairs of a bucket; and all rows of the runs in which a row had more of them than were kept."""
    p = np.concatenate([P.records(x, _POST) for x in group["_posts"].to_pylist()])
    p = p[np.lexsort((p["place"], p["chunk"], p["tie"], p["id"], p["pair"], p["code"]))]
    new = np.zeros(len(p), np.int64)
    new[1:] = (p["code"][1:] != p["code"][:-1]) | (p["pair"][1:] != p["pair"][:-1])
    run = np.cumsum(new)
    y, x, more = P.meet(p["n"], p["pos"], run, LEAST, P.KEPT, (p["s1"], p["s2"]))
    both = np.stack([p["chunk"][y], p["place"][y], p["chunk"][x], p["place"][x]], 1)
    both, at = np.unique(both, axis=0, return_index=True) if len(y) else (both, np.zeros(0, np.int64))
    apart = np.bitwise_count(p["s1"][y[at]] ^ p["s1"][x[at]]).astype(np.int32) + np.bitwise_count(p["s2"][y[at]] ^ p["s2"][x[at]])
    crowd = np.flatnonzero(np.isin(run, run[more]))
    n, m, c = len(both), len(crowd), p[crowd]
    none = np.zeros(n, np.int64)
    values = [
        np.concatenate([both[:, 0], c["chunk"]]), np.concatenate([both[:, 1], c["place"]]), np.concatenate([both[:, 2], c["chunk"]]), np.concatenate([both[:, 3], c["place"]]), np.concatenate([apart, np.zeros(m, np.int32)]),
        np.concatenate([none, np.full(m, key[0].as_py())]), np.concatenate([none - 1, run[crowd]]), *(np.concatenate([none, c[k].view(f"i{c[k].itemsize}")]) for k in ("id", "tie", "n", "pos", "s1", "s2")), np.concatenate([none > 0, more[crowd]]),
    ]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.table({name: pa.array(v).cast(k) for name, v, k in zip(_MET, values, kinds, strict=True)})


def _more(key: tuple, group: pa.Table) -> pa.Table:
    """All candidate pairs of a run for the rows that still ask."""
    c = {name: group[name].to_numpy() for name in group.column_names}
    order = np.lexsort((c["yp"], c["yc"], c["tie"], c["id"]))
    s1, s2 = (c[k][order].view(np.uint64) for k in ("s1", "s2"))
    y, x, _ = P.meet(c["n"][order], c["pos"][order], np.zeros(len(order), np.int64), LEAST, None, (s1, s2), asks=c["asks"][order].astype(bool))
    y, x = order[y], order[x]
    return pa.table({"yc": c["yc"][y], "yp": c["yp"][y], "xc": c["yc"][x], "xp": c["yp"][x]})


class _Lines:
    """Lines of chunk files by their number; the last chunk stays."""

    def __init__(self, folder: str):
        self.folder, self.chunk = folder, None

    def of(self, chunk: int) -> Buffer:
        if self.chunk != chunk:
            self.chunk, self.buffer = chunk, Buffer(get_rows(self.folder, f"{chunk}.arrow")["_text"])
        return self.buffer


def _confirmed(pairs: DataFrame, folder: str) -> DataFrame:
    """(yc, yp) of the pairs whose lines, fetched from their chunks, are alike: the one line is sent to the other's chunk.

    About COMPARED pairs of a chunk meet in a task; those of a chunk with more are dealt over several.
    """

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = _Lines(folder)
        for batch in batches:
            text = [lines.of(c).line(i) for c, i in zip(batch["yc"].to_pylist(), batch["yp"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("yc", "yp", "xc", "xp", "xpart")), pa.array(text, pa.binary())], ["yc", "yp", "xc", "xp", "xpart", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = _Lines(folder)
        for batch in batches:
            same: list[bool] = []
            for (chunk, place), rows in groupby(zip(batch["xc"].to_pylist(), batch["xp"].to_pylist(), batch["text"].to_pylist(), strict=True), key=lambda r: r[:2]):
                x = set(lines.of(chunk).line(place).split())
                for r in rows:
                    y = set(r[2].split())
                    same.append(9 * len(x & y) >= 4 * (len(x) + len(y)))
            yield batch.select(["yc", "yp"]).filter(pa.array(same, pa.bool_()))

    tasks = max(2 * pairs.sparkSession.sparkContext.defaultParallelism, pairs.count() // COMPARED)
    for chunk, part in (("xc", "xpart"), ("yc", "ypart")):
        parts = pairs.groupBy(F.col(chunk).alias("_of")).agg(F.ceil(F.count(F.lit(1)) / COMPARED).alias("_parts"))
        pairs = pairs.join(parts, F.col(chunk) == F.col("_of")).withColumn(part, F.pmod(F.xxhash64("yc", "yp", "xc", "xp"), F.col("_parts"))).drop("_of", "_parts")
    fetched = pairs.repartition(tasks, "yc", "ypart").sortWithinPartitions("yc").mapInArrow(ship, "yc long, yp int, xc long, xp int, xpart long, text binary")
    same = fetched.repartition(tasks, "xc", "xpart").sortWithinPartitions("xc", "xp").mapInArrow(compare, "yc long, yp int")
    return written(same.distinct(), "similar-lines")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: list[str] | None = None) -> DataFrame:
    """Removes each line that an earlier line of the corpus resembles: Jaccard similarity of their word sets of 4/5 or more.

    Lines are cut at newlines and ordered by id_col (an integer; null first), by 32 bits of a hash of the text where ids are equal,
    and by their number; a line without words is never removed. A line is judged against all earlier lines of the input, whether
    these are removed or not. Tokens are ordered by how many lines hold them; lines meet on the tokens of their prefixes, pass the
    length and the positional filter and a bound from parities of their tokens' hashes, and are verified on their words.

    Returns id_col, n_lines, n_removed, blank (whether no word is left) and text (the lines left, joined by newlines), and the columns
    of docs that are carried, as the struct _rest; a row for each row of docs. A null or empty text is one line without words; of a
    repeated row only the first keeps its lines; an empty table gives an empty one; other columns are ignored.

    The texts are written once into chunk files of the shared folder, and only sets, prefixes and lines to compare are shuffled.
    Equal sets are merged before they are compared, by two independent 64-bit hashes of their whole words: two different lines share both by
    chance once in 10^38 pairs, and no words of up to eight bytes and one length do. All other removals are verified on the words. A line of which two
    words share the 40 bits of a token may keep its place beside one that it resembles. A token's rows beyond RUN are dealt over groups of two blocks each. Of its
    candidates a line is first compared with the nearest, then, if that is not alike, with all others; a row that left a long run
    early, and found none alike, meets the whole run.
    """
    spark = docs.sparkSession
    before = made()
    folder = new_folder(spark, "line-chunks")
    make_folder(folder)
    text = F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(col(id_col).cast("long").alias("_id"), F.shiftright(F.xxhash64(text), 32).cast("int").alias("_tie"), text.alias("_text"), *([F.struct(*[col(c) for c in carried]).alias("_rest")] if carried else []))
    stored = written(_stored(rows, folder), "line-sets")
    chunks = stored.where("size is not null").select("chunk", "gone", "size")
    count, total = (x or 0 for x in chunks.agg(F.count("chunk"), F.sum("size")).first())
    logs = spark.sparkContext.broadcast(P.frequencies(stored.where("piece is not null").select("piece", F.col("chunk").alias("part"), "slots", "counts")))
    buckets = max(8, total >> 21)
    tasks = max(1, count // 4, min(count, 2 * spark.sparkContext.defaultParallelism))

    sets = stored.where("k1 is not null").select("k1", "k2", "chunk", "place", "id", "tie")
    first = F.min(F.struct(F.col("id").isNotNull().alias("known"), "id", "tie", "chunk", "place")).alias("first")
    repeated = sets.groupBy(F.col("k1").alias("_1"), F.col("k2").alias("_2")).agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    others = sets.join(repeated, (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2"))).where((F.col("chunk") != F.col("first.chunk")) | (F.col("place") != F.col("first.place")))
    others = written(others.groupBy("chunk").agg(F.collect_list("place").alias("others")), "line-repeats")
    chunks = written(chunks, "line-left")
    forget(before, "line-sets")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for chunk, gone, places in zip(batch["chunk"].to_pylist(), batch["gone"].to_pylist(), batch["others"].to_pylist(), strict=True):
                rows = get_rows(folder, f"{chunk}.arrow")
                drop = np.concatenate([np.frombuffer(gone, "<u4").astype(np.int64), np.array(places or [], np.int64)])
                held.append(_postings(Buffer(rows["_text"]), drop, logs.value, chunk, rows["_id"].fill_null(-(2**63)), rows["_tie"]))
                size += len(held[-1])
                if size >= SENT:
                    yield _sent(held, buckets)
                    held, size = [], 0
        if size:
            yield _sent(held, buckets)

    posts = chunks.join(others, "chunk", "left").repartition(tasks).mapInArrow(post, "_bucket long, _posts binary")
    met = written(posts.groupBy("_bucket").applyInArrow(_met, _MET_SQL), "line-met")
    logs.destroy()
    pairs = met.where("run < 0").select("yc", "yp", "xc", "xp", "apart")
    nearest = pairs.groupBy("yc", "yp").agg(F.min(F.struct("apart", "xc", "xp")).alias("_x"))
    nearest = written(nearest.select("yc", "yp", F.col("_x.xc").alias("xc"), F.col("_x.xp").alias("xp")), "line-nearest")
    similar = _confirmed(nearest, folder)
    waiting = written(nearest.join(similar, ["yc", "yp"], "left_anti"), "line-waiting")
    if not waiting.isEmpty():
        had = waiting.withColumnsRenamed({"xc": "_xc", "xp": "_xp"})
        rest = pairs.join(had, ["yc", "yp"]).where((F.col("xc") != F.col("_xc")) | (F.col("xp") != F.col("_xp"))).select("yc", "yp", "xc", "xp")
        crowds = met.where("run >= 0").join(had, ["yc", "yp"], "left").withColumn("asks", F.col("asks") & F.col("_xc").isNotNull()).select("bucket", "run", "yc", "yp", "id", "tie", "n", "pos", "s1", "s2", "asks")
        crowds = crowds.join(crowds.where("asks").select("bucket", "run").distinct(), ["bucket", "run"], "left_semi")
        rest = rest.unionByName(crowds.groupBy("bucket", "run").applyInArrow(_more, "yc long, yp int, xc long, xp int")).distinct()
        similar = similar.unionByName(_confirmed(written(rest, "line-rest"), folder))
    alike = written(similar.groupBy(F.col("yc").alias("chunk")).agg(F.collect_list("yp").alias("alike")), "line-alike")
    forget(before, "line-met", "line-nearest", "similar-lines", "line-waiting", "line-rest")

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, gone, places, alike in zip(*(batch[c].to_pylist() for c in ("chunk", "gone", "others", "alike")), strict=True):
                rows = get_rows(folder, f"{chunk}.arrow")
                bad = {*np.frombuffer(gone, "<u4").tolist(), *(places or []), *(alike or [])}
                texts, counts, removed, at = rows["_text"].to_pylist(), [], [], 0
                for i, text in enumerate(texts):
                    counts.append(text.count("\n") + 1)
                    out = [j - at for j in range(at, at + counts[-1]) if j in bad]
                    removed.append(len(out))
                    at += counts[-1]
                    if out:
                        lines = text.split("\n")
                        for j in reversed(out):
                            del lines[j]
                        texts[i] = "\n".join(lines)
                blank = [not t.strip(" \t\n\v\f\r") for t in texts]
                columns = [rows["_id"].combine_chunks(), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(blank), pa.array(texts, pa.string()), *([rows["_rest"].combine_chunks()] if carried else [])]
                yield pa.RecordBatch.from_arrays(columns, out_names)

    out = T.StructType([*(T.StructField(n, T.LongType()) for n in (id_col, "n_lines", "n_removed")), T.StructField("blank", T.BooleanType()), T.StructField("text", T.StringType()), *([T.StructField("_rest", rows.schema["_rest"].dataType)] if carried else [])])
    out_names = out.names
    return chunks.join(others, "chunk", "left").join(alike, "chunk", "left").repartition(tasks).mapInArrow(left, out)


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The columns of docs, texts without the lines that resemble earlier ones and length_col their length.

    A document of which no word is left repeats earlier ones as a whole and goes; any other stays, since later lines were removed
    because of its own, and so does one from which nothing was removed. Its id is an integer.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    got = line_dedup(docs, id_col, text_col, others).where((F.col("n_removed") == 0) | ~F.col("blank"))
    rest = {c: F.col("_rest").getField(c) for c in others} | ({length_col: F.length("text").cast(docs.schema[length_col].dataType)} if length_col in others else {})
    return got.select(*[col(id_col).cast(docs.schema[id_col].dataType).alias(c) if c == id_col else F.col("text").alias(c) if c == text_col else rest[c].alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the text left) of each document."""
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
