"""Writers: Parquet tables, importer CSV files and viewer templates."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import batches
from ..operators.graph import for_csv
from . import shared


def parquet(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


#: Headers of id columns in the importer's files.
NODE_HEADERS = {"segments": {"body": ":ID(Body-ID)", "label": ":LABEL"}, "synapses": {"point_id": ":ID(Element-ID)", "label": ":LABEL"}, "sets": {"id": ":ID(SynSet-ID)"}, "elements": {"point_id": ":ID(Element-ID)", "label": ":LABEL"}, "element_sets": {"id": ":ID(ElementSet-ID)"}, "meta": {}}
EDGE_HEADERS = {
    "connections": {"body_pre": ":START_ID(Body-ID)", "body_post": ":END_ID(Body-ID)"},
    "synapse_connections": {"pre_id": ":START_ID(Element-ID)", "post_id": ":END_ID(Element-ID)"},
    "set_to_set": {"start_id": ":START_ID(SynSet-ID)", "end_id": ":END_ID(SynSet-ID)"},
    "neuron_to_set": {"body": ":START_ID(Body-ID)", "id": ":END_ID(SynSet-ID)"},
    "set_to_synapse": {"id": ":START_ID(SynSet-ID)", "point_id": ":END_ID(Element-ID)"},
    "neuron_to_element_set": {"body": ":START_ID(Body-ID)", "id": ":END_ID(ElementSet-ID)"},
    "element_set_to_element": {"id": ":START_ID(ElementSet-ID)", "point_id": ":END_ID(Element-ID)"},
    "close_to": {"source_id": ":START_ID(Element-ID)", "target_id": ":END_ID(Element-ID)"},
}


def importer_csv(df: DataFrame, kind: str, path: str, measured: bool = False) -> None:
    """Node or edge files with the importer's headers; measured as in typed_names()."""
    csv(for_csv(df, {**NODE_HEADERS, **EDGE_HEADERS}[kind], measured), path)


#: Rows of a file of nodes; a batch with more rows has more files.
ROWS_A_FILE = 1_000_000


def node_batches(df: DataFrame, rois: str, kind: str, path: str, files: int, rows_a_file: int = ROWS_A_FILE, measured: bool = False) -> DataFrame:
    """Node files by region combination: rows of one combination stand together, and a batch has a flag column only for
    regions that its combinations have. Returns the batches as batches.regions() lists them.

    rois is a column of comma-joined region names; it isn't written. There are at most `files` batches and those that
    are too big to share one. Lines go to {path}/rows/batch=N and the header to {path}/headers/batch=N, as the importer
    takes a header file and any number of files of rows. A batch's rows are dealt out by their hash to as many tasks as
    it fills files, so a combination of a third of all rows is written by many tasks.
    """
    plan = shared.saved(batches.of_groups(df, rois, files), "batches")
    told = shared.saved(batches.regions(plan, rois), "batch_regions")
    x = batches.with_batch(df, rois, plan)
    x = x.join(told.select("batch", F.col("rows").alias("_rows"), F.col("regions").alias("_regions")), "batch")
    own = [c for c in df.columns if c != rois]
    typed = for_csv(x.select(*own, "batch", "_rows", "_regions", F.col(rois).alias("_rois")), {**{**NODE_HEADERS, **EDGE_HEADERS}[kind], "batch": "batch", "_rows": "_rows", "_regions": "_regions", "_rois": "_rois"}, measured, ("_regions",))
    names = [c for c in typed.columns if c not in ("batch", "_rows", "_regions", "_rois")]
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in names)), {"escape": '"', "emptyValue": "", "nullValue": ""})
    flags = F.when(F.size("_regions") > 0, F.concat(F.lit(","), F.array_join(batches.flags(F.col("_rois"), F.col("_regions")), ","))).otherwise(F.lit(""))
    part = F.pmod(F.xxhash64(line), F.ceil(F.col("_rows") / rows_a_file))
    lines = typed.select(F.concat(line, flags).alias("value"), "batch", part.alias("_part")).repartition("batch", "_part").drop("_part")
    lines.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).partitionBy("batch").text(f"{path}/rows")
    first = ",".join(f'"{n}"' if "," in n or '"' in n else n for n in names)
    head = F.concat(F.lit(first), F.array_join(F.transform("regions", lambda r: F.concat(F.lit(","), r, F.lit(":boolean"))), ""))
    told.select(head.alias("value"), "batch").repartition("batch").write.mode("overwrite").partitionBy("batch").text(f"{path}/headers")
    return told


def arrow(df: DataFrame, path: str) -> None:
    """A table as Arrow files, one for each partition, written where the rows are, to a folder that all executors share
    (a path as readers.ArrowFiles takes it). Beside each file stand the least and greatest values of its batches' integer
    columns, by which a reader skips batches."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyarrow import fs as pafs
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(df.schema)

    def write(batches):
        from pyspark import TaskContext

        fs, folder = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        fs.create_dir(folder, recursive=True)
        part, n, stats = TaskContext.get().partitionId(), 0, []
        name = f"{folder}/part-{part:05d}"
        own = f"{name}.{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(own) as f, pa.ipc.new_file(f, schema) as w:
            for b in batches:
                w.write_batch(pa.RecordBatch.from_arrays(b.columns, schema=schema) if b.schema != schema else b)
                whole = [c for c in schema if pa.types.is_integer(c.type)]
                stats.append({c.name: [x.as_py() for x in pc.min_max(b.column(schema.get_field_index(c.name))).values()] for c in whole})
                n += b.num_rows
        with fs.open_output_stream(f"{own}.json") as f:
            f.write(json.dumps(stats).encode())
        fs.move(f"{own}.json", f"{name}.stats.json")
        fs.move(own, f"{name}.arrow")  # a repeated task replaces its file whole
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([n])], ["part", "n"])

    df.mapInArrow(write, "part long, n long").agg(F.sum("n")).collect()


def viewer_state(template: str, values: dict[str, str]) -> str:
    """A viewer's JSON state with its placeholders filled."""
    for k, v in values.items():
        template = template.replace(k, v)
    json.loads(template)
    return template
