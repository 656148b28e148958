"""Re-reading an upload folder (D20) without parsing its old files again.

Uploads are never moved, so every validation reads the whole folder, and a new
file may change the label of an old row (rule 3).  The gate therefore always
gets all rows; what is kept between runs is their parsed form:

    upload_rows    the rows of parsed files, with the id of their parse
    upload_files   the files whose rows are current: name, length, modification
                   time, header, parse

A run lists the folder, parses the files that are new or changed and takes the
rows of the others from the store.  Rows of changed and removed files stay on
disk but no file row names their parse.

A file is the same when name, length and modification time are.  A file changed
less than SETTLED seconds before it was listed is not kept: a second change
could leave both values as they are, so the next run parses it again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotgate.operators.lookups import bounded_broadcast
from lotgate.plans.publish import Append
from lotgate.session import materialize
from lotgate.sources.uploads import file_name, list_uploads, read_headers, read_uploads

FILES_TABLE = "upload_files"
ROWS_TABLE = "upload_rows"
SETTLED = 60
FILES_SCHEMA = "source_file string, length long, modified timestamp, header array<string>, parse string"
_PARSE = "_parse"


@dataclass
class Parsed:
    rows: DataFrame
    changes: dict  # what a publish of this run adds to the store
    parsed_files: list[str]


def _columns(headers: list[list[str]]) -> list[str]:
    """The columns of a union by name of files with these headers, in order."""
    return list(dict.fromkeys([*headers[0], "source_file", *(c for h in headers[1:] for c in h)]))


def parsed_uploads(spark: SparkSession, folder: str, model: Mapping[str, DataFrame], multiline: bool = False) -> Parsed:
    """The rows of every ``*.csv`` in *folder*, as :func:`read_uploads` gives
    them, with the rows of unchanged files from *model*.  One row per file
    reaches the driver, as its listing does."""
    known = {r["source_file"]: r for r in model[FILES_TABLE].collect()} if FILES_TABLE in model else {}
    listed = {file_name(r["path"]): r for r in list_uploads(spark, folder)}
    same = {name for name, r in listed.items()
            if name in known and (known[name]["length"], known[name]["modified"]) == (r["length"], r["modified"])}
    fresh = [r["path"] for name, r in listed.items() if name not in same]
    found = read_headers(spark, fresh) if fresh else {}
    headers = {name: known[name]["header"] if name in same else found[r["path"]] for name, r in listed.items()}
    parse, limit = uuid.uuid4().hex, time.time() - SETTLED
    files = [(name, r["length"], r["modified"], headers[name], known[name]["parse"] if name in same else parse)
             for name, r in listed.items() if name in same or r["modified"].timestamp() < limit]
    changes = {FILES_TABLE: spark.createDataFrame(files, FILES_SCHEMA)}
    frames = []
    if same:
        kept = spark.createDataFrame([(name, known[name]["parse"]) for name in same], f"source_file string, {_PARSE} string")
        frames.append(model[ROWS_TABLE].join(bounded_broadcast(kept), ["source_file", _PARSE], "left_semi").drop(_PARSE))
    if fresh:
        rows = materialize(read_uploads(spark, fresh, multiline, found), "uploads")  # parsed once, read by the gate twice
        frames.append(rows)
        kept = spark.createDataFrame([(f[0],) for f in files if f[0] not in same], "source_file string")
        changes[ROWS_TABLE] = Append(rows.join(bounded_broadcast(kept), "source_file", "left_semi").withColumn(_PARSE, F.lit(parse)))
    out = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)
    return Parsed(out.select(*[F.col(f"`{c}`") for c in _columns(list(headers.values()))]), changes, [file_name(p) for p in fresh])
