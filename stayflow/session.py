"""Session helper and the shared work folder used to cut lineage."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: number columns that share an array in a stored table of very many columns
PACK = 256


def get_session(app: str = "stayflow", cpus: str | int = "*", **conf: str) -> SparkSession:
    """Local session for tests and benches; a cluster supplies its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a
    folder would vanish with its machine.
    """
    named = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="stayflow-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for one step; afterwards it is as before."""
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/stayflow/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike a cache this survives the loss of executors and ends the lineage;
    unlike an RDD checkpoint the copy is columnar, so later reads are pruned.
    """
    spark = df.sparkSession
    path = new_folder(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(c: str) -> str:
    """A column name as SQL text; a thousand columns of text are built far sooner than a thousand ``Column``."""
    return "`" + c.replace("`", "``") + "`"


def materialize_wide(df: DataFrame, tag: str) -> DataFrame:
    """:func:`materialize` for very many double columns: the same columns and rows are read back.

    Parquet keeps a buffer and a dictionary for each column, and a row of a thousand
    columns touches them all. Stored are arrays of ``PACK`` columns, plain and compressed.
    """
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    packs = [doubles[a : a + PACK] for a in range(0, len(doubles), PACK)]
    others = [quoted(c) for c in df.columns if c not in set(doubles)]
    packed = df.selectExpr(*others, *[f"array({', '.join(map(quoted, p))}) AS _pack{i}" for i, p in enumerate(packs)])
    path = new_folder(df.sparkSession, tag)
    packed.write.options(**{"compression": "zstd", "parquet.enable.dictionary": "false"}).parquet(path)
    place = {c: f"get(_pack{i}, {j}) AS {quoted(c)}" for i, p in enumerate(packs) for j, c in enumerate(p)}
    stored = df.sparkSession.read.schema(packed.schema).parquet(path)
    return stored.selectExpr(*[place.get(c, quoted(c)) for c in df.columns])
