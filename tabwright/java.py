"""Java classes of this package, compiled by the compiler that Spark brings along."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Class loader of every source, by application.
LOADERS: dict = {}


def java_object(spark: SparkSession, source: str, name: str):
    """A new object of the public class ``name`` of the file ``source``, known to executors too.

    Each application compiles a file once and sends the classes to its executors as a jar.
    """
    sc = spark.sparkContext
    known = (sc.applicationId, source)
    if known not in LOADERS:
        with open(source, encoding="utf-8") as f:
            text = f.read()
        compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(sc._jsc.getClass().getClassLoader())
        compiler.cook(text)
        tag = hashlib.sha256(text.encode()).hexdigest()[:16]
        path = os.path.join(tempfile.mkdtemp(prefix="tabwright-java-"), f"tabwright-{tag}.jar")
        with zipfile.ZipFile(path, "w") as jar:
            for entry in compiler.getBytecodes().entrySet():
                jar.writestr(entry.getKey().replace(".", "/") + ".class", bytes(entry.getValue()))
        sc._jsc.addJar(f"file://{path}")
        LOADERS[known] = compiler.getClassLoader()
    return LOADERS[known].loadClass(name).newInstance()


def map_partitions(df: DataFrame, function, schema: str) -> DataFrame:
    """``df`` through a Java ``MapPartitionsFunction`` whose rows have ``schema``."""
    jvm = df.sparkSession._jvm
    kind = jvm.org.apache.spark.sql.types.StructType.fromDDL(schema)
    return DataFrame(df._jdf.mapPartitions(function, jvm.org.apache.spark.sql.Encoders.row(kind)), df.sparkSession)
