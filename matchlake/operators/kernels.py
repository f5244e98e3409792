"""``Kernels.java`` as SQL functions: the loops over rows of tree training, inside Spark's JVMs.

The source is compiled once a session by the compiler that Spark generates its own code
with, and goes to the executors as a jar. Where that fails, or with ``MATCHLAKE_KERNELS=0``,
``ready`` says so and the numpy twins are used: the same trees, several times slower.

The packed rows of a table of up to ``KERNEL_ROWS`` rows are one value, broadcast to the
executors once a job, so neither shuffle nor disk grow with the number of fits.
"""

from __future__ import annotations

import os
import struct
import tempfile
import uuid
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.binned import dealt_to_groups, gathered
from matchlake.session import cut_lineage

KERNEL_ROWS = 1 << 22
FUNCTIONS = {"matchlake_votes": "Votes", "matchlake_grow": "Grow", "matchlake_boost": "Boost"}
READY: dict[tuple, bool] = {}


def ready(spark: SparkSession) -> bool:
    """Whether the functions can be called."""
    if os.environ.get("MATCHLAKE_KERNELS") == "0":
        return False
    key = spark.sparkContext.applicationId, spark._jsparkSession.hashCode()
    if key not in READY:
        try:
            registered(spark)
            params = numbers(1, 1, 1 << 30, 2, 1, 42, 0, 0, 0, 1, 0)
            probe = called("grow", F.lit(bytes(11)), F.lit(params), F.lit(bytes(256)))
            READY[key] = len(spark.range(1).select(probe.alias("tree")).first()["tree"]) == 14
        except Exception:  # noqa: BLE001  whatever is missing, the numpy twins do without it
            READY[key] = False
    return READY[key]


def registered(spark: SparkSession) -> None:
    compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "Kernels.java")) as f:
        compiler.cook(f.read())
    classes = compiler.getBytecodes()
    path = os.path.join(tempfile.mkdtemp(prefix="matchlake-kernels-"), f"kernels-{uuid.uuid4().hex[:12]}.jar")
    with zipfile.ZipFile(path, "w") as jar:
        for name in classes:
            jar.writestr(name.replace(".", "/") + ".class", bytes(classes[name]))
    spark.sparkContext._jsc.sc().addJar(path)
    binary = spark._jsparkSession.parseDataType('"binary"')
    for name, kind in FUNCTIONS.items():
        function = compiler.getClassLoader().loadClass(f"matchlake.Kernels${kind}").newInstance()
        spark._jsparkSession.udf().register(name, function, binary)


def called(name: str, *args: Column) -> Column:
    return F.call_function(f"matchlake_{name}", *args)


def numbers(*values: int | float) -> bytes:
    """Longs and doubles, eight bytes each."""
    return b"".join(struct.pack("<d" if isinstance(v, float) else "<q", v) for v in values)


def marked(folds) -> bytes:
    """A byte for each fold number: whether it is one of ``folds``."""
    return bytes(f in set(folds) for f in range(256))


def one_blob(rows: DataFrame, features: int) -> DataFrame:
    """(rows): the packed rows of a table of at most ``KERNEL_ROWS``, in one order, written once."""
    def joined(blobs: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"rows": [gathered(blobs["rows"], features).tobytes()]})

    return cut_lineage(dealt_to_groups(rows, [0], features).groupBy("g").applyInPandas(joined, "rows binary"))


def tasks(blob: DataFrame, units: list[tuple], schema: str) -> DataFrame:
    """A task for each unit, which has the packed rows beside its values."""
    spark = blob.sparkSession
    table = spark.createDataFrame(spark.sparkContext.parallelize(units, max(1, len(units))), schema)
    return table.crossJoin(F.broadcast(blob))
