"""Export folders of JSON lines: written in two phases, never over one that is there, and read only if their report's digests hold.

A folder holds parts in the order of their rows. Each part begins with a header
line `{"meta": ...}`; report.json names all parts with bytes, rows and digest.
Tasks write parts into a folder of their job; the commit moves those of the
attempts that Spark chose, writes the report last, and removes the rest, so an
export is there as a whole or not at all.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from fragloom.functions.shipping import ship
from fragloom.operators.export import COLUMNS
from fragloom.sources.metadata import with_header

FORMAT, REPORT = "exports", "report.json"
OBSERVATION = "id long, type_id long, type int, lang string, url string, observed_at string, fragments long, primary_fragments long, assembly string, position_joins long, bounded_fallback boolean, search string, text string"


class Spoilt(RuntimeError):
    """An export that is not what its report says, or that changed what it was made from."""


@dataclass
class Part(WriterCommitMessage):
    """A written part: its place in the order, its file, and what the report says of it."""

    place: int
    name: str
    bytes: int
    rows: int
    sha256: str


class _Digesting:
    """A file that is hashed as it is written."""

    def __init__(self, out) -> None:
        self.out, self.digest, self.size = out, hashlib.sha256(), 0

    def write(self, data: bytes) -> int:
        self.digest.update(data)
        self.size += len(data)
        self.out.write(data)
        return len(data)

    def flush(self) -> None:
        pass


class _Writer(DataSourceArrowWriter):
    def __init__(self, options) -> None:
        self.path, self.meta, self.zipped = options["path"].rstrip("/"), options.get("meta", "{}"), options.get("compression", "gzip") == "gzip"
        self.job = f"_writing-{uuid.uuid4().hex}"
        json.loads(self.meta)
        system, path = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(path).type != fs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists; choose a new folder")

    def write(self, iterator):
        system, path = fs.FileSystem.from_uri(self.path)
        place, name, rows = TaskContext.get().partitionId(), f"part-{uuid.uuid4().hex}", 0
        system.create_dir(f"{path}/{self.job}", recursive=True)
        with system.open_output_stream(f"{path}/{self.job}/{name}", compression=None) as raw:
            seen = _Digesting(raw)
            out = gzip.GzipFile(fileobj=seen, mode="wb", compresslevel=6, mtime=0, filename="") if self.zipped else seen
            out.write(f'{{"meta":{self.meta}}}\n'.encode())
            for batch in iterator:
                rows += batch.num_rows
                for line in batch.column(0).cast(pa.binary()):  # one at a time, as a batch can be large
                    x = line.as_py()
                    if x is None or b"\n" in x:
                        raise ValueError("a row is no single line")
                    out.write(x + b"\n")
            if self.zipped:
                out.close()
        return Part(place, name, seen.size, rows, seen.digest.hexdigest())

    def commit(self, messages):
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(path, recursive=True)
        parts = sorted((m for m in messages if m), key=lambda m: m.place)
        kept = [m for m in parts if m.rows] or parts[:1]  # a part without rows says nothing; of an empty export one header stays
        files = []
        for k, m in enumerate(kept):
            name = f"part-{k:05d}.jsonl{'.gz' if self.zipped else ''}"
            system.move(f"{path}/{self.job}/{m.name}", f"{path}/{name}")
            files.append({"name": name} | {k: v for k, v in asdict(m).items() if k in ("bytes", "rows", "sha256")})
        self._clean()
        with system.open_output_stream(f"{path}/_{REPORT}") as out:
            out.write(json.dumps({"meta": json.loads(self.meta), "files": files, "rows": sum(f["rows"] for f in files)}, ensure_ascii=False).encode())
        system.move(f"{path}/_{REPORT}", f"{path}/{REPORT}")

    def abort(self, messages):
        self._clean()
        system, path = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(path).type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(path)):
            system.delete_dir(path)

    def _clean(self) -> None:
        system, path = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(f"{path}/{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{path}/{self.job}")


class ExportSource(DataSource):
    """`df.write.format("exports")` of one column of JSON lines, after register(spark). Options: path, meta (a JSON object), compression (gzip or none)."""

    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(ExportSource)


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:/") else f"file://{path}"


def write_lines(rows: DataFrame, path: str, order: list[str], meta: dict, compression: str = "gzip") -> dict:
    """Write rows as JSON lines in the order, and return the export's report. Ranges of the order are sorted apart, each in a part of its own."""
    register(rows.sparkSession)
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    line = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")
    parts.select(line).write.format(FORMAT).mode("append").option("meta", json.dumps(meta, ensure_ascii=False)).option("compression", compression).save(_uri(path))
    return report(path)


def report(path: str) -> dict:
    """The report of an export that was committed."""
    system, folder = fs.FileSystem.from_uri(_uri(path))
    with system.open_input_stream(f"{folder}/{REPORT}") as f:
        return json.loads(f.read())


def write_articles(articles: DataFrame, path: str, meta: dict, **options) -> dict:
    """Articles with all that was recovered, in order of url, date, language, type."""
    rows = articles.withColumnRenamed("lang", "language").withColumnRenamed("type", "segmentation_type")
    return write_lines(rows, path, ["url", "date", "language", "segmentation_type"], meta, **options)


def write_observations(rows: DataFrame, path: str, meta: dict, **options) -> dict:
    """Observations, with whatever further columns they have, in order of their id; what is read back must be what was written."""
    done = write_lines(rows.select(*COLUMNS, *[c for c in rows.columns if c not in COLUMNS]), path, ["id"], meta, **options)
    changed(rows, path)
    return done


def changed(rows: DataFrame, path: str) -> None:
    """Raises Spoilt, and removes the export, unless it holds the original columns of rows unchanged, each as often."""
    _, back = read_observations(rows.sparkSession, path)
    own = rows.select(*[F.col(c).cast(t) for c, t in (x.split(" ") for x in OBSERVATION.split(", "))])
    told = [x.agg(F.count("*"), F.sum(F.xxhash64(*COLUMNS).cast("decimal(38,0)"))).first() for x in (own, back.select(*COLUMNS))]
    if told[0] != told[1]:
        system, folder = fs.FileSystem.from_uri(_uri(path))
        system.delete_dir(folder)
        raise Spoilt(f"{path} does not hold the observations unchanged")


def verified(spark: SparkSession, path: str) -> list[str]:
    """Paths of an export's parts, whose number, bytes and digests must be those of its report."""
    known = {f["name"]: (f["bytes"], f["sha256"]) for f in report(path)["files"]}
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.col("path"), "length", F.sha2("content", 256).alias("sha256")).collect()  # a row a part
    there = {r["path"].rsplit("/", 1)[-1]: (r["length"], r["sha256"]) for r in found}
    if bad := sorted(n for n in known.keys() | there.keys() if known.get(n) != there.get(n)):
        raise Spoilt(f"{path}: {', '.join(bad)} differ from the report")
    return sorted(r["path"] for r in found)


def read_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Headers (file, meta) and rows (file, line_no and the schema's columns) of an export that holds what its report says."""
    return with_header(spark, verified(spark, path), schema)


def read_observations(spark: SparkSession, path: str, more: str = "") -> tuple[DataFrame, DataFrame]:
    """Headers and observations; more: further columns, as a schema."""
    return read_lines(spark, path, OBSERVATION + (f", {more}" if more else ""))


def read_articles(spark: SparkSession, path: str, manifests: DataFrame, schema: str) -> DataFrame:
    """Articles of a verified export whose source files (raw_path, raw_sha256) the manifests vouch for; any other fails, as does an identity that stands twice."""
    from fragloom.operators import audit

    _, rows = read_lines(spark, path, schema)
    if loose := audit.unbound(rows, manifests).select("raw_path").take(1):
        raise Spoilt(f"no manifest vouches for {loose[0][0]}")
    if twice := audit.repeated_identities(rows, ["raw_sha256", "url", "date", "language", "segmentation_type"]).take(1):
        raise Spoilt(f"{twice[0]['url']} stands there {twice[0]['n']} times")
    if mixed := audit.algorithms_by_type(rows.withColumnRenamed("segmentation_type", "type")).take(1):
        raise Spoilt(f"type {mixed[0]['type']} has {mixed[0]['algorithms']} algorithms")
    return rows
