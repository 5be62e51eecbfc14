"""Shared machinery of the training-data operators: scratch tables, connected components, bucket verification.

Nothing in here collects rows of the data to the driver. Intermediate tables go to the shared folder that the
cluster names in ``spark.checkpoint.dir``, so a lost executor costs a recomputation of its tasks and nothing else.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN_ROOT: dict[str, str] = {}
_LEFT: list[tuple[SparkSession, str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves, but only under a local master; on a cluster the absence
    is an error, since a machine-local folder would not be seen by the other machines.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_ROOT:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _OWN_ROOT[app] = "file://" + tempfile.mkdtemp(prefix="fiscalis-")
    return _OWN_ROOT[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; removed when the driver ends."""
    path = f"{scratch_root(spark)}/fiscalis-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    _LEFT.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that has been superseded."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _remove_left() -> None:
    for spark, path in _LEFT:
        try:
            remove(spark, path)
        except Exception:  # the session is gone already; nothing depends on these files
            return


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column of ``taken`` resolves to it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def place(columns: list[str], name: str) -> int:
    """Where the column is that Spark resolves ``name`` to: the exact name, else the one that differs in case."""
    if name in columns:
        return columns.index(name)
    return [c.lower() for c in columns].index(name.lower())


BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Hold batches to Python at ``BATCH_BYTES`` at most, so that long texts do not add up; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(key)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends here, and each task ran once.

    Afterwards the shuffle files that led to the table are of no use; a collection on the driver lets Spark's
    cleaner delete them, so that steps do not add up on the disks.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    del df
    back = spark.read.schema(_nullable_schema(spark, path)).parquet(path)
    back._scratch = path
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return back


def _nullable_schema(spark: SparkSession, path: str):
    return spark.read.parquet(path).schema


_KINDS = {
    "int": T.IntegerType(), "integer": T.IntegerType(), "long": T.LongType(), "bigint": T.LongType(), "string": T.StringType(),
    "binary": T.BinaryType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "array<int>": T.ArrayType(T.IntegerType()),
    "array<long>": T.ArrayType(T.LongType()), "array<string>": T.ArrayType(T.StringType()),
}


def fields(schema: str) -> T.StructType:
    """A StructType from its DDL text; without a session for the plain types that ``_KINDS`` lists."""
    pairs = [x.strip().split(" ", 1) for x in schema.split(",")]
    if all(len(x) == 2 and x[1] in _KINDS for x in pairs):
        return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])
    return T.StructType.fromDDL(schema)


_EDGES = 200_000


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same nodes: each node but the least of its component with that one."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    up = np.arange(len(nodes))
    while True:
        low = np.minimum(up[a], up[b])
        nxt = up.copy()
        np.minimum.at(nxt, up[a], low)
        np.minimum.at(nxt, up[b], low)
        while (nxt[nxt] != nxt).any():
            nxt = nxt[nxt]
        if (nxt == up).all():
            break
        up = nxt
    other = np.flatnonzero(up != np.arange(len(nodes)))
    return nodes[other], nodes[up[other]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`contracted` edges of a task, ``_EDGES`` at a time."""
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        ends = contracted(*(table.column(c).to_numpy() for c in ("u", "v")))
        return pa.RecordBatch.from_arrays([pa.array(x, table.schema.field(0).type) for x in ends], ["u", "v"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= _EDGES:
            yield flush()
            held = []
    if held:
        yield flush()


def connected_components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Distributed union-find: ``edges (u, v)`` of any orderable type -> ``(node, root)``, root the least node reachable.

    Alternating large-star and small-star contractions; each round is two aggregations and two joins over the edge
    list, which never grows beyond its first size. Before each, every task contracts the edges that it reads, and tasks
    are as many as the edges ask for, so that few edges take few rounds of few files. A hub is the heavy side of a join against one row per node, which
    adaptive execution splits. Rounds grow with the logarithm of the component's diameter. Self loops are allowed;
    an empty edge list gives an empty result.
    """
    cur = materialize(edges.select("u", "v").filter("u <> v").distinct(), label)
    mark, n = None, cur.count()
    while True:
        tasks = 1 + n // _EDGES
        own = cur.coalesce(tasks).mapInArrow(_contract, cur.schema)
        both = own.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        sym = both.select("e.u", "e.v")
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(down.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        nxt = materialize(small.coalesce(tasks), label)
        row = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        remove(nxt.sparkSession, cur._scratch)
        cur = nxt
        if (row.n, row.s) == mark or row.n == 0:
            break
        mark, n = (row.n, row.s), row.n
    out = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return out.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal key columns in a sorted stream of batches, across batch borders, one table per run."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        cut = np.zeros(batch.num_rows, bool)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        starts = np.flatnonzero(cut)
        at = 0
        for s in starts.tolist():
            held.append(batch.slice(at, s - at))
            yield pa.Table.from_batches(held)
            held, at = [], s
        held.append(batch.slice(at))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list, list]]:
    """Bucket, ids and payloads of each group in a stream sorted by ``bucket, i, j``; lists, since most groups are tiny."""
    ids: list = []
    payload: list = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in ("bucket", "i", "j")]
        cut = np.zeros(batch.num_rows, bool)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        own_ids, own_payload = batch.column("id").to_pylist(), batch.column("payload").to_pylist()
        if ids and tuple(c[0] for c in cols) != last:
            yield last[0], ids, payload
            ids, payload = [], []
        at = 0
        for end in np.flatnonzero(cut).tolist():
            yield int(cols[0][at]), ids + own_ids[at:end], payload + own_payload[at:end]
            ids, payload, at = [], [], end
        ids += own_ids[at:]
        payload += own_payload[at:]
        last = tuple(c[-1].item() for c in cols)
    if ids:
        yield last[0], ids, payload


def _with_first(n: int, at: int, pairs: Iterable[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[int]]:
    """The pairs, and the indices below ``n`` that they do not connect with ``at``."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = list(pairs)
    for x, y in kept:
        up[top(x)] = top(y)
    root = top(at)
    return kept, [i for i in range(n) if top(i) != root]


def bucket_edges(
    members: DataFrame,
    payload: str,
    linker: Callable[[list], Iterable[tuple[int, int]]],
    block: int = 1024,
    label: str = "buckets",
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Verified links inside buckets: ``members (bucket long, id long, <payload>)`` -> spanning edges ``(u, v)``.

    ``linker(payloads)`` gets the payloads of one group and yields index pairs that span the components of its true
    links, so a group of n rows gives less than n edges, never all pairs. A bucket beyond ``block`` rows is cut into
    blocks, and each block meets the bucket's first row: rows that it reaches are connected already and need not meet
    one another. The rows that are left meet all blocks, themselves in blocks, so every link is found, each group is
    bounded, and the groups of a hot bucket spread over the cluster. A bucket of n rows with r left is copied
    1 + r / block times, not n / block times.

    Where the sizes are known, ``sizes (bucket, n)`` has those above 1, and the rows of ``members`` their bucket's ``n``.
    """
    own = members.select("bucket", "id", F.col(payload).alias("payload"), *(["n"] if sizes is not None else []))
    if sizes is None:
        sizes = materialize(own.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), f"{label}-sizes")
        small = own.join(sizes.filter(F.col("n") <= block), "bucket")
    else:
        small, own = own.filter(F.col("n") <= block), own.drop("n")
    schema = fields("u long, v long, left boolean")

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.select("bucket", "i", "j", "id", "payload").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def batch(rows: list[tuple[int, int, bool]]) -> pa.RecordBatch:
        u, v, left = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(left, pa.bool_())], schema.names)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, bool]] = []
        for _, ids, load in _members(batches):
            if len(ids) > 1:
                out += [(ids[x], ids[y], False) for x, y in linker(load)]
            if len(out) > 8192:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def link_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges of a block with the bucket's first row, which has the least id; and the rows that it does not reach."""
        for bucket, ids, load in _members(batches):
            kept, rest = _with_first(len(ids), ids.index(min(ids)), linker(load))
            out = [(ids[x], ids[y], False) for x, y in kept] + [(ids[x], bucket, True) for x in rest]
            if out:
                yield batch(out)

    zero = F.lit(0)
    small = small.withColumn("i", zero).withColumn("j", zero)
    edges = dealt(small).mapInArrow(link, schema).select("u", "v")
    hot = sizes.filter(F.col("n") > block)
    if hot.isEmpty():
        return edges
    big = own.join(hot.withColumn("nb", F.ceil(F.col("n") / F.lit(block)).cast("int")), "bucket")
    big = materialize(big.withColumn("i", F.pmod(F.xxhash64("id", F.lit(7)), F.col("nb")).cast("int")).drop("n"), f"{label}-hot")
    first = big.groupBy("bucket", "nb").agg(F.min("id").alias("id"))
    heads = big.join(first.select("bucket", "id"), ["bucket", "id"]).dropDuplicates(["bucket"])
    everywhere = heads.withColumn("i", F.explode(F.sequence(zero, F.col("nb") - 1)))
    rest = big.join(heads.select("bucket", "id"), ["bucket", "id"], "left_anti").select(*everywhere.columns)
    met = materialize(dealt(rest.unionByName(everywhere).withColumn("j", zero)).mapInArrow(link_first, schema), f"{label}-met")
    edges = edges.unionByName(met.filter("not left").select("u", "v"))
    left = met.filter("left").select(F.col("v").alias("bucket"), F.col("u").alias("id")).distinct()
    counts = left.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("nu"))
    again = big.join(counts, "bucket").withColumn("j", F.explode(F.sequence(zero, F.col("nu") - 1)))
    lone = big.join(left, ["bucket", "id"]).join(counts, "bucket").withColumn("j", F.pmod(F.xxhash64("id", F.lit(9)), F.col("nu")).cast("int"))
    lone = lone.withColumn("i", F.explode(F.sequence(zero, F.col("nb") - 1)))
    return edges.unionByName(dealt(again.unionByName(lone.select(*again.columns))).mapInArrow(link, schema).select("u", "v"))


def hex16(col) -> F.col:
    """A 64-bit number as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))
