"""Files of a folder tree without what its rule files leave out.

Rule files stand in any folder and hold a pattern a line, as version control has them: ``#`` begins a comment, ``!`` takes
files in again, a final ``/`` means folders only, a pattern with another ``/`` counts from the file's own folder and one
without at any depth; ``*``, ``?``, ``[...]`` and ``**`` stand for characters. Of the rules that match a path the last one
of the deepest rule file decides, and what lies in a folder that is left out stays out.

Rules are a table by folder, and a path meets the rules of its ancestors in an equi-join. Folders are decided once, not for
each of their files. Defined results: null paths are dropped, null rule texts hold no rule, repeated paths stay, patterns
that are no patterns match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Files with more bytes are reported, not read, and the name of rule files (fixed values).
MOST_BYTES, RULE_FILE = 1 << 20, ".gitignore"
#: Folders of dependencies, builds and caches that stay out unless a rule takes them in (fixed values).
DEFAULT_FOLDERS = """node_modules bower_components jspm_packages web_modules .yarn .pnpm-store
.next .nuxt .svelte-kit .turbo .vite .parcel-cache .angular .docusaurus storybook-static .vinxi .nitro out-tsc .vercel
.netlify .wrangler dist build out .output coverage .nyc_output __pycache__ __pypackages__ .venv venv .pixi .pdm-build
.mypy_cache .pytest_cache .ruff_cache .tox .nox .hypothesis .ipynb_checkpoints .eggs target .gradle obj vendor .build Pods
Carthage DerivedData .swiftpm .dart_tool .pub-cache .cxx .externalNativeBuild vcpkg_installed .bloop .metals lua_modules
.luarocks __history __recovery .cache *.egg-info cmake-build-* bazel-*""".split()


def expression(pattern: Column) -> Column:
    """The regular expression of a pattern without ``!`` and final ``/``, for paths from its folder on."""
    anchored = pattern.contains("/")
    body = F.regexp_replace(pattern, r"^/", "")
    body = F.regexp_replace(body, r"([.+^$(){}|])", r"\\$1")
    body = F.regexp_replace(F.regexp_replace(body, r"\[!", "[^"), r"(^|/)\*\*/", "$1\u0001")
    body = F.regexp_replace(F.regexp_replace(body, r"/\*\*$", "/\u0002"), r"\*+", "[^/]*")
    body = F.replace(F.replace(F.replace(body, F.lit("?"), F.lit("[^/]")), F.lit("\u0001"), F.lit("(?:.*/)?")), F.lit("\u0002"), F.lit(".+"))
    return F.concat(F.lit("^"), F.when(anchored, "").otherwise("(?:.*/)?"), body, F.lit("$"))


def _valid(pattern: Column) -> Column:
    """Brackets that close; whatever else a pattern has becomes a valid expression."""
    return F.regexp_replace(pattern, r"\[[^\]]+\]", "").rlike(r"[\[\]]") == F.lit(False)


def rules(files: DataFrame, defaults: list[str] | tuple = ()) -> DataFrame:
    """(folder, nth, negated, dirs_only, regex) of the rule files (path, text); ``defaults`` come before all of them."""
    own = files.where(S.basename(F.col("path")) == RULE_FILE).select(F.regexp_replace("path", r"/?[^/]*$", "").alias("folder"), F.posexplode(F.split("text", r"\r?\n")).alias("nth", "line"))
    if defaults:
        more = files.sparkSession.createDataFrame([("", k - len(defaults), f"{d}/") for k, d in enumerate(defaults)], "folder string, nth int, line string")
        own = own.unionByName(more)
    own = own.withColumn("line", F.regexp_replace("line", r"(?<!\\)\s+$", "")).where(~F.col("line").rlike("^(#|$)"))
    negated = F.col("line").startswith("!")
    own = own.withColumns({"negated": negated, "line": F.regexp_replace(F.when(negated, F.substring("line", 2, 1 << 20)).otherwise(F.col("line")), r"^\\([#!])", "$1")})
    dirs = F.col("line").endswith("/")
    own = own.withColumns({"dirs_only": dirs, "line": F.regexp_replace("line", "/$", "")}).where((F.col("line") != "") & _valid(F.col("line")))
    return own.select("folder", "nth", "negated", "dirs_only", expression(F.replace(F.col("line"), F.lit("\\"), F.lit(""))).alias("regex"))


def _prefixes(path: Column) -> Column:
    """(prefix, is_dir) of a path and of all folders around it."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(F.array_join(F.slice(parts, F.lit(1), n), "/").alias("prefix"), (n < F.size(parts)).alias("is_dir")))


def kept_paths(paths: DataFrame, ruled: DataFrame) -> DataFrame:
    """The rows of ``paths`` (path, ...) that no rule leaves out, neither themselves nor by a folder around them."""
    own = paths.where(F.col("path").isNotNull())
    every = own.select(F.explode(_prefixes(F.col("path"))).alias("p")).select("p.prefix", "p.is_dir").distinct()
    parts = F.split("prefix", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    met = every.select("prefix", "is_dir", F.explode(above).alias("folder")).join(ruled, "folder")
    inside = F.when(F.col("folder") == "", F.col("prefix")).otherwise(F.expr("substring(prefix, length(folder) + 2)"))
    met = met.withColumn("inside", inside).where((~F.col("dirs_only") | F.col("is_dir")) & F.expr("inside rlike regex"))
    out = met.groupBy("prefix", "is_dir").agg(F.max_by("negated", F.struct(F.length("folder"), F.col("nth"))).alias("negated")).where("not negated").select("prefix", "is_dir")
    gone = own.select("path", F.explode(_prefixes(F.col("path"))).alias("p")).select("path", "p.prefix", "p.is_dir").join(out, ["prefix", "is_dir"], "left_semi").select("path").distinct()
    return own.join(gone, "path", "left_anti")


def _rule_files(folders: DataFrame, uri: str, most_bytes: int) -> DataFrame:
    """(path, text) of the rule files in the folders. Spark's sources pass hidden files over, so tasks open them."""
    import pyarrow as pa
    from pyarrow.fs import FileSystem

    schema = pa.schema([("path", pa.string()), ("text", pa.string())])

    def run(batches):
        fs, base = FileSystem.from_uri(uri)
        for batch in batches:
            names = [f"{f}/{RULE_FILE}".lstrip("/") for f in batch.column(0).to_pylist()]
            found = [n for n, i in zip(names, fs.get_file_info([f"{base}/{n}" for n in names])) if i.is_file and i.size <= most_bytes]
            texts = [fs.open_input_file(f"{base}/{n}").read().decode("utf-8", "replace") for n in found]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(texts, pa.string())], schema=schema)

    return folders.mapInArrow(run, "path string, text string")


def scan(spark: SparkSession, root: str, most_bytes: int = MOST_BYTES, defaults: list[str] | tuple = tuple(DEFAULT_FOLDERS)) -> DataFrame:
    """(path, size, modified, text, error) of the files below ``root``, with paths from there; larger ones have no text.

    Hidden files are not read. ``root`` lies where Spark and pyarrow both reach it."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    top = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString().rstrip("/")
    uri = "file://" + top.removeprefix("file:") if top.startswith("file:/") and not top.startswith("file://") else top
    inside = F.expr(f"substring(regexp_replace(path, '^[a-z]+:/+', '/'), {len('/' + top.split(':', 1)[-1].lstrip('/')) + 2})")
    listed = read.select(inside.alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    folders = listed.select(F.explode(F.transform(F.filter(_prefixes(F.col("path")), lambda p: p["is_dir"]), lambda p: p["prefix"])).alias("folder")).distinct()
    folders = folders.unionByName(spark.createDataFrame([("",)], "folder string"))
    wanted = kept_paths(listed, rules(_rule_files(folders, uri, most_bytes), defaults))
    texts = read.where(F.col("length") <= most_bytes).select(inside.alias("path"), F.decode("content", "UTF-8").alias("text"))
    error = F.when(F.col("size") > most_bytes, F.format_string(f"File exceeds max size (%d > {most_bytes})", "size"))
    return wanted.join(texts, "path", "left").select("path", "size", "modified", "text", error.alias("error"))
