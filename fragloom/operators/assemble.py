"""Groups of fragments to articles: one shuffle of packed runs by group, then the kernels, one group at a time."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

from fragloom import schema as S
from fragloom.functions.shipping import ship
from fragloom.kernels.clusterwise import Options, assemble_clusters
from fragloom.kernels.evidence import broken
from fragloom.kernels.wordwise import assemble_body, assemble_words
from fragloom.settings import ALGORITHMS, Settings

KEY = ["url", "date", "lang", "type"]
_PIECES = pa.list_(pa.struct([("pos", pa.int16()), ("text", pa.string())]))


@contextlib.contextmanager
def _no_collection() -> Iterator[None]:
    """The kernels make many small objects and no circles; looking for circles takes a third of their time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _groups(column: pa.ListArray) -> Iterator[list[tuple[int, str]]]:
    """(pos, text) lists of an array of structs, one at a time."""
    for at in range(len(column)):
        flat = column.slice(at, 1).flatten()
        yield list(zip(flat.field("pos").to_pylist(), flat.field("text").to_pylist(), strict=True))


#: Columns of packed fragments.
_PACKED = pa.schema([("pos", pa.int16()), ("line_no", pa.int64()), ("text", pa.string())])


def _packed(rows: pa.RecordBatch) -> bytes:
    """Fragments as bytes: neighbouring windows repeat each other, so that they take a small part of their size. They stay columns, no value becomes a Python object."""
    plain = rows.serialize()
    return plain.size.to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def _rows(run: bytes) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.decompress(run[8:], int.from_bytes(run[:8], "little"), "zstd"), _PACKED)


def texts_of(runs: Iterable[bytes]) -> Iterator[str | None]:
    """Texts of packed runs, in the order of their rows; one run is unpacked at a time."""
    for run in runs:
        yield from _rows(run).column("text").to_pylist()


def unpacked(runs: Iterable[bytes]) -> list[tuple[int, int, str]]:
    """(pos, line_no, text) of the packed runs of a group, in order of pos, then line (null first), then text."""
    batches = [_rows(run) for run in runs]
    rows = pa.Table.from_batches(batches, _PACKED)
    if rows["pos"].null_count:
        return sorted(zip(*[c.to_pylist() for c in rows.columns], strict=True), key=lambda f: (f[0], -1 if f[1] is None else f[1], f[2]))
    pos, lines = rows["pos"].to_numpy(), pc.fill_null(rows["line_no"], -1).to_numpy()
    order = np.lexsort((lines, pos))
    rows, pos, lines = rows.take(order), pos[order], lines[order]
    out = list(zip(pos.tolist(), rows["line_no"].to_pylist() if rows["line_no"].null_count else lines.tolist(), rows["text"].to_numpy().tolist(), strict=True))
    if bool(((pos[1:] == pos[:-1]) & (lines[1:] == lines[:-1])).any()):
        out.sort(key=lambda f: (f[0], -1 if f[1] is None else f[1], f[2]))
    return out


def pack(key: list[str], kind: pa.Schema, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the fragments that a batch has of a group."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        new[0] = True
        for c in key:
            own = batch.column(c)
            new[1:] |= pc.fill_null(pc.not_equal(own.slice(1), own.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        keys = batch.select(key).take(pa.array(starts))
        rows = pa.RecordBatch.from_arrays([batch.column(c).cast(_PACKED.field(c).type) for c in _PACKED.names], schema=_PACKED)
        runs: dict[tuple, list[int]] = {}
        for k, named in enumerate(zip(*[c.to_pylist() for c in keys.columns], strict=True)):
            runs.setdefault(named, []).append(k)
        ends, sizes, blobs = [*starts[1:].tolist(), n], [], []
        starts = starts.tolist()
        for at in runs.values():
            own = rows.take(pa.array(np.concatenate([np.arange(starts[k], ends[k]) for k in at]))) if len(at) > 1 else rows.slice(starts[at[0]], ends[at[0]] - starts[at[0]])
            sizes.append(own.num_rows)
            blobs.append(_packed(own))
        keys = keys.take(pa.array([at[0] for at in runs.values()]))
        yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())], schema=kind)


def packed_runs(fragments: DataFrame, key: list[str]) -> DataFrame:
    """key, _n, _run: the fragments that a batch of rows has of a group, packed to one row."""
    ship(fragments.sparkSession)
    rows = fragments.select(*key, F.col("pos").cast("smallint").alias("pos"), F.col("line_no").cast("long").alias("line_no"), "text")
    schema = StructType([rows.schema[c] for c in key]).add("_n", "long").add("_run", "binary")
    kind = to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: pack(key, kind, batches), schema)


def tasks(spark: SparkSession) -> int:
    """Tasks for work that its bytes do not show, as packed runs are few bytes and much work: several for each core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def packed_groups(fragments: DataFrame, key: list[str], limit: int, packed: DataFrame | None = None) -> DataFrame:
    """key, inputs, runs (the group's fragments, packed). A group beyond the limit fails the job before any kernel runs. packed: packed_runs of the fragments, if they are there already."""
    out = (packed_runs(fragments, key) if packed is None else packed).repartition(tasks(fragments.sparkSession), *key).groupBy(*key).agg(F.sum("_n").alias("inputs"), F.collect_list("_run").alias("runs"))
    return out.where(F.when(F.col("inputs") <= limit, True).otherwise(F.raise_error(F.lit("a group has too many fragments")).cast("boolean")))


#: Rows of a batch that a kernel gives back, unless their groups have this many fragments before.
_ROWS, _FRAGMENTS = 64, 100_000


def per_group(groups: DataFrame, schema: StructType, run) -> DataFrame:
    """groups (with inputs, runs), each through run(row without runs, fragments), which gives a row of the schema; rows are handed on by few, so that memory is that of a group."""
    kind = to_arrow_schema(schema)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                out.append(run(row, unpacked(row.pop("runs"))))
                held += row["inputs"]
                if len(out) == _ROWS or held >= _FRAGMENTS:
                    yield pa.RecordBatch.from_pylist(out, kind)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)

    return groups.mapInArrow(work, schema)


def _pieces(rows: list[tuple[int, str]]) -> list[dict]:
    return [{"pos": p, "text": t} for p, t in rows]


def _words(fragments: list[tuple[int, str]]) -> dict:
    with _no_collection():
        r = assemble_words(fragments, at_once=True)
    return {"text": r.text, "merged": r.merged, "unmerged": _pieces(r.unmerged)}


def _body(fragments: list[tuple[int, str]]) -> dict:
    with _no_collection():
        r = assemble_words(fragments, at_once=True)
        b = assemble_body(r.text, r.unmerged)
    return {"text": None, "merged": r.merged, "unmerged": None, "left_over": len(r.unmerged), "body": {"text": b.text, "joins": b.joins, "bounded": b.bounded}}


def _clusters(fragments: list[tuple[int, str]], options: Options) -> dict:
    with _no_collection():
        r = assemble_clusters(fragments, options)
    best = r.best_effort and {
        "text": r.best_effort.text, "minimum_overlap": r.best_effort.minimum_overlap, "ordering": r.best_effort.ordering,
        "joins": [{"section": s, "method": m, "overlap": k} for s, m, k in r.best_effort.joins],
        "position_only_joins": r.best_effort.position_only, "comparison_budget_exhausted": r.best_effort.exhausted,
    }
    return {
        "text": r.text, "merged": r.merged, "unmerged": _pieces(r.unmerged),
        "diagnostics": {
            "minimum_overlap_used": r.minimum_overlap_used, "stop_reason": r.stop_reason, "search_status": r.search_status, "conflicts": r.conflicts,
            "search_steps": r.search_steps, "primary_members": r.primary,
            "segments": [{"text": s.text, "min_pos": s.min_pos, "max_pos": s.max_pos, "members": s.members, "stop_reason": s.stop_reason} for s in r.sections],
            "best_effort": best,
        },
    }


def assemble_body_column(text: Column, unmerged: Column) -> Column:
    """struct<text, joins, bounded>: the text and, as paragraphs, what did not join it."""

    def run(texts: pa.Array, rest: pa.Array) -> pa.Array:
        with _no_collection():
            found = [assemble_body(t, r) for t, r in zip(texts.to_pylist(), _groups(rest), strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array([b.text for b in found], pa.string()), pa.array([b.joins for b in found], pa.int32()), pa.array([b.bounded for b in found])], ["text", "joins", "bounded"]
        )

    return F.arrow_udf(run, S.BODY)(text, unmerged)


def grouped(fragments: DataFrame, key: list[str], limit: int = Settings().max_article_fragments) -> DataFrame:
    """key, fragments (array of pos, line_no, text in order of pos, then line), inputs. A group beyond the limit fails the job before any kernel runs."""
    groups = packed_groups(fragments, key, limit)
    schema = StructType([groups.schema[c] for c in key]).add("fragments", DataType.fromDDL(f"array<{S.FRAGMENT}>")).add("inputs", "long")
    return per_group(groups, schema, lambda row, own: row | {"fragments": _listed(own)})


def _listed(fragments: list[tuple[int, int, str]]) -> list[dict]:
    return [{"pos": p, "line_no": n, "text": t} for p, n, t in fragments]


def articles(fragments: DataFrame, settings: Settings = Settings(), source: list[str] | None = None, keep_fragments: bool = False, evidence: bool = False, bodies: bool = False, packed: DataFrame | None = None) -> DataFrame:
    """One article a group (per source file, if `source` names its columns), with its fragments, or with what evidence it breaks (`broken`), if asked for.

    Both kinds take one shuffle together. A group is unpacked as its kernel
    begins, so memory is that of a group, not of a batch. With bodies, articles
    of kind 1 have left_over (how many fragments did not join) and body (text,
    joins, bounded) in place of text and unmerged: what did not join stays in
    its task instead of going back and forth in batches of many articles.
    packed: packed_runs of the fragments by the same key, if they are there already.
    """
    key = [*(source or []), *KEY]
    groups = packed_groups(fragments, key, settings.max_article_fragments, packed)
    options = Options(settings.type2_min_overlap, settings.type2_max_position_gap, settings.type2_search_budget, settings.type2_best_effort, settings.type2_best_effort_min_overlap)
    types = settings.types
    schema = StructType([groups.schema[c] for c in key]).add("algorithm", "string").add("completeness", "string").add("inputs", "long").add("text", "string").add("merged", "long")
    schema = schema.add("unmerged", DataType.fromDDL(S.PIECES)).add("diagnostics", DataType.fromDDL(S.DIAGNOSTICS))
    if keep_fragments:
        schema = schema.add("fragments", DataType.fromDDL(f"array<{S.FRAGMENT}>"))
    if evidence:
        schema = schema.add("broken", DataType.fromDDL("array<string>"))
    if bodies:
        schema = schema.add("left_over", "long").add("body", DataType.fromDDL(S.BODY))
    empty = {"text": None, "merged": None, "unmerged": None}

    def run(row: dict, own: list[tuple[int, int, str]]) -> dict:
        pairs = [(p, t) for p, _, t in own]
        found = (_body(pairs) if bodies else _words(pairs)) if row["type"] == 1 else _clusters(pairs, options) if row["type"] == 2 and 2 in types else empty
        out = row | found | {"algorithm": ALGORITHMS[1 if row["type"] == 1 else 2], "completeness": "not_verified"} | ({"fragments": _listed(own)} if keep_fragments else {})
        if bodies and row["type"] != 1:
            out |= {"left_over": None if out["unmerged"] is None else len(out["unmerged"]), "body": None}
        # looked at where the fragments are, so that they need not travel with the article
        return out | {"broken": broken(_listed(own), out) if "diagnostics" in out else []} if evidence else out

    return per_group(groups, schema, run)
