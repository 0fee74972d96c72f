"""Functions of this subpackage that run in the executors' JVM: loops over single ids and characters, too slow in Python.

The Java sources in ``java/`` are compiled once an application by the compiler that Spark itself brings for generated
code, put into a jar that the driver serves to all executors, and registered as SQL functions of the session.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

#: SQL function -> (class, type of its result).
FUNCTIONS = {
    "tidemark_range_encode": ("tidemark.RangeCoder$Encode", "binary"),
    "tidemark_range_decode": ("tidemark.RangeCoder$Decode", "binary"),
    "tidemark_ints": ("tidemark.RangeCoder$Ints", "array<int>"),
}

_loaded: dict[str, dict] = {}


def _load(spark: SparkSession) -> dict:
    """class name -> class, with the jar on its way to the executors."""
    app = spark.sparkContext.applicationId
    if app not in _loaded:
        jvm = spark.sparkContext._jvm
        path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark-llm.jar")
        classes = {}
        with zipfile.ZipFile(path, "w") as z:
            for source in sorted((Path(__file__).parent / "java").glob("*.java")):
                compiler = jvm.org.codehaus.janino.SimpleCompiler()
                compiler.cook(source.read_text())
                loader = compiler.getClassLoader()
                for name, code in dict(compiler.getBytecodes()).items():
                    z.writestr(name.replace(".", "/") + ".class", bytes(code))
                    classes[name] = loader.loadClass(name)
        spark.sparkContext._jsc.addJar(path)
        _loaded[app] = classes
    return _loaded[app]


def register(spark: SparkSession, name: str, kind: str, result: str, *arguments) -> None:
    """Make an object of class *kind* from *arguments* (bytes or strings) the SQL function *name* of the session."""
    gateway = spark.sparkContext._gateway
    values, types = gateway.new_array(gateway.jvm.Object, len(arguments)), gateway.new_array(gateway.jvm.Class, len(arguments))
    for k, x in enumerate(arguments):
        values[k], types[k] = x, gateway.jvm.Class.forName("[B" if isinstance(x, (bytes, bytearray)) else "java.lang.String")
    made = _load(spark)[kind].getConstructor(types).newInstance(values)
    session = spark._jsparkSession
    session.udf().register(name, made, session.parseDataType(_parse_datatype_string(result).json()))


def call(spark: SparkSession, name: str, *columns: Column) -> Column:
    """The function *name* of FUNCTIONS applied to columns."""
    register(spark, name, *FUNCTIONS[name])
    return F.call_udf(name, *columns)
