"""Updates and deletions of a stored Parquet table: only the files that hold matching rows are written anew.

The files are found by one join that reads the columns of the condition. Their changed rows are
written to a hidden folder of the table, with a list of the files they replace; giving that folder its final name
commits the change. What is left to do then, moving files in and old ones out, can be repeated: the
next change of the table, or ``finish_change``, ends a commit that was broken off. All other
files stay as they are, byte for byte.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidArgument, InvalidState
from .folder import Folder as _Folder, table_folder as _folder
from .ingest import add_rows, identifier
from .query import run_many

_STAGED, _COMMITTED, _LIST = "_tableferry_staged_", "_tableferry_commit_", "_replaces"


def finish_change(spark: SparkSession, table: str) -> int:
    """Ends commits of the table that were broken off, and tells how many there were."""
    folder = _folder(spark, table)
    commits = sorted(name for name in folder.files() if name.startswith(_COMMITTED))
    for commit in commits:
        there, old = folder.files(commit), json.loads(folder.read(commit, _LIST))
        # New names are of this commit alone, so a file that has been moved is not there twice.
        for name in there:
            if name != _LIST and name[0] not in "_.":
                folder.move(folder.at(commit, name), folder.at(f"{commit[len(_COMMITTED):]}-{name}"))
        for name in old:
            folder.delete(name)
        folder.delete(commit)
    if commits:
        spark.sql(f"REFRESH TABLE {identifier(table)}")
    return len(commits)


def apply_many(spark: SparkSession, table: str, params: DataFrame, on: dict[str, str] | list[str], action: str = "update", **how) -> int:
    """``run_many`` on a stored table, which is changed; returns the rows affected.

    Takes ``update``, ``delete`` and ``insert`` with the arguments of ``run_many``. A job that fails before its commit leaves
    the table as it was. While a commit moves its files, other readers may see the old or new rows of a file, both or neither
    for a moment. Two changes of one file do not mix: the later one is refused when it finds a file gone or changed.
    """
    if action not in ("update", "delete", "insert"):
        raise InvalidArgument(f"a stored table cannot be changed by {action!r}")
    folder = _folder(spark, table)
    finish_change(spark, table)
    stored = spark.table(table)
    if action == "insert":
        result = run_many(stored.where("false"), params, on, "insert", **how)
        count = result.affected.first()[0]
        add_rows(result.frame, table)
        return count
    condition = {name: how[name] for name in ("where", "between") if how.get(name)}
    before = folder.files()
    # Columns that only the condition of a select needs are read; a match counts once per file.
    matches = run_many(stored.select("*", F.col("_metadata.file_name").alias("__file")), params, on, "select", **condition)
    touched = sorted(r[0] for r in matches.frame.select("__file").distinct().collect())
    if not touched:
        return 0
    rows = spark.read.schema(stored.schema).parquet(*[f"{folder.path}/{name}" for name in touched])
    result = run_many(rows, params, on, action, **how)
    mark = uuid.uuid4().hex[:12]
    stage, commit = _STAGED + mark, _COMMITTED + mark
    try:
        result.frame.write.parquet(f"{folder.path}/{stage}")
        count = result.affected.first()[0]
        folder.write(json.dumps(touched), stage, _LIST)
        now = folder.files()
        if changed := [name for name in touched if now.get(name) != before.get(name)]:
            raise InvalidState(f"files of {table.upper()} were changed by another job: {', '.join(changed)}")
    except BaseException:
        folder.delete(stage)
        raise
    folder.move(folder.at(stage), folder.at(commit))
    finish_change(spark, table)
    return count
