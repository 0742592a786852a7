"""Claims that several drivers and tasks can make at once: ranges of ids, and slots of a run.

Everything rests on one operation: a whole file that appears under its name only
if nothing has that name yet. HDFS renames so, and a local filesystem links so; a
store without such an operation can't be used here.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomery.config import InputError
from loomery.sources.sink import opened, qualified

TRIES = 1000
SLOT = "slot_id string, status string, output string, error string"


def create_if_absent(target: fs.FileSystem, path: str, content: bytes) -> bool:
    """Whether the file was made by this call; it shows with all its content or not at all."""
    target.create_dir(path.rpartition("/")[0], recursive=True)
    partial = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.partial"
    with target.open_output_stream(partial) as out:
        out.write(content)
    try:
        if isinstance(target, fs.LocalFileSystem):
            os.link(partial, path)
        else:
            target.move(partial, path)
        return True
    except OSError:
        if target.get_file_info(path).type == fs.FileType.NotFound:
            raise
        return False
    finally:
        if target.get_file_info(partial).type != fs.FileType.NotFound:
            target.delete_file(partial)


def _read(target: fs.FileSystem, path: str) -> dict:
    with target.open_input_stream(path) as data:
        return json.loads(data.read())


def claim(spark: SparkSession, folder: str, prefix: str, count: int = 1, taken: int = 0, width: int = 3) -> list[str]:
    """The next ``count`` ids of a prefix, no one else's: claims follow each other without a gap or a repeat.

    Claim k is the file <prefix>.k, which says where its range ends, so the next range begins there. Who comes
    second to a file takes the next one. ``taken`` is the highest number in use before there were claims.
    """
    if count < 1:
        raise InputError("CLAIM_COUNT", f"cannot claim {count} ids")
    target, base = opened(qualified(spark, folder))
    pattern = re.compile(rf"{re.escape(prefix)}\.([0-9]{{12}})")
    target.create_dir(base, recursive=True)
    for _ in range(TRIES):
        known = [(int(m[1]), i.path) for i in target.get_file_info(fs.FileSelector(base)) if (m := pattern.fullmatch(i.base_name))]
        number, last = max(known, default=(0, None))
        end = _read(target, last)["end"] if last else taken
        if create_if_absent(target, f"{base}/{prefix}.{number + 1:012d}", json.dumps({"first": end + 1, "end": end + count}).encode()):
            return [f"{prefix}{n:0{width}d}" for n in range(end + 1, end + count + 1)]
    raise InputError("CLAIM_FAILED", f"no claim of {prefix!r} in {TRIES} tries", "others claim faster; try again")


def _slot_file(slot: str) -> str:
    """A file name of any slot id; parts of the id outside plain characters are hexadecimal."""
    return "".join(c if c.isascii() and (c.isalnum() or c in "-_") else f"%{ord(c):x}." for c in slot) + ".json"


def states(spark: SparkSession, folder: str) -> DataFrame:
    """(slot_id, status, output, error) of all slots that have ended."""
    target, base = opened(qualified(spark, folder))
    if target.get_file_info(f"{base}/slots").type == fs.FileType.NotFound:
        return spark.createDataFrame([], SLOT)
    return spark.read.schema(SLOT).json(f"{folder.rstrip('/')}/slots")


def run_slots(planned: DataFrame, folder: str, work: Callable[[dict], str | None], retry: tuple[str, ...] = ("failed",)) -> DataFrame:
    """Run the planned slots (slot_id and whatever ``work`` needs) that haven't ended, and give all slots' states.

    ``work`` takes a row and gives the output's name; what it raises makes the slot failed. The task writes the
    slot's state as soon as the slot ends, whole and once: a run that is killed keeps what has ended, and the next one
    is an anti-join over it. Of two attempts of one slot the first to end counts. Failed slots run again in a later run, unless ``retry`` says otherwise.
    """
    spark = planned.sparkSession
    full = qualified(spark, folder)
    done = states(spark, folder)
    names = planned.columns
    again = done.where(F.col("status").isin(*retry)).select("slot_id", F.lit(True).alias("_again"))
    open_ = planned.join(done.where(~F.col("status").isin(*retry)).select("slot_id"), "slot_id", "left_anti").join(again, "slot_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = opened(full)
        for batch in batches:
            n = 0
            for row in batch.to_pylist():
                state = {"slot_id": row["slot_id"], "status": "ok", "output": None, "error": None}
                path = f"{base}/slots/{_slot_file(row['slot_id'])}"
                try:
                    state["output"] = work({c: row[c] for c in names})
                except Exception as e:  # a slot that fails is a state
                    state |= {"status": "failed", "error": f"{type(e).__name__}: {e}"[:500]}
                if row["_again"] and target.get_file_info(path).type != fs.FileType.NotFound and _read(target, path)["status"] in retry:
                    target.delete_file(path)
                n += create_if_absent(target, path, (json.dumps(state, ensure_ascii=False) + "\n").encode())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    open_.mapInArrow(run, "n bigint").agg(F.sum("n")).collect()
    return states(spark, folder)
