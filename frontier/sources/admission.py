"""Admission of bucket folders to a stream (ST-2, SS-2, SS-3).

A bucket is complete at its start plus twice the interval. :func:`admit` goes through the
folders behind the last admitted one in order, writes an admission (the bucket and the files it
then holds) for each that is ready, and stops at the first that isn't, so a later bucket never
overtakes an earlier one. The stream reads admissions, one a trigger, and opens only the files
they name: those of a bucket that isn't ready stay unread, and a replay reads what the first
attempt read. A folder that turns up behind the mark is never admitted; :func:`overtaken` lists
such folders and files."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from . import files

_DATE, _TIME = re.compile(r"(?:date=)?([0-9]{8})"), re.compile(r"(?:time=)?([0-9]{4})")
_SUFFIXES = (".json", ".jsonl", ".json.gz", ".jsonl.gz")


def _start(mark: str) -> datetime | None:
    try:
        return datetime.strptime(mark, "%Y%m%d%H%M").replace(tzinfo=timezone.utc)
    except ValueError:
        return None


def bucket_folders(spark: SparkSession, root: str, since: str = "") -> list[tuple[str, str]]:
    """(mark ``yyyyMMddHHmm``, path) of the bucket folders whose day isn't before that of ``since``, in order."""
    root, found = root.rstrip("/"), []
    for day, folder in files.names(spark, root):
        d = _DATE.fullmatch(day)
        if not folder or not d or d[1] < since[:8]:
            continue
        for time, inner in files.names(spark, f"{root}/{day}"):
            t = _TIME.fullmatch(time)
            if inner and t and _start(d[1] + t[1]):
                found.append((d[1] + t[1], f"{root}/{day}/{time}"))
    return sorted(found)


def admitted(spark: SparkSession, admissions: str) -> list[str]:
    """Marks of the admitted buckets, in order."""
    return [n.removesuffix(".json") for n, folder in files.names(spark, admissions) if n.endswith(".json") and not folder and not n.startswith("_")]


def admit(spark: SparkSession, root: str, admissions: str, as_of: datetime, interval_minutes: int = 10) -> list[str]:
    """Admits the buckets that are ready at ``as_of``; returns their marks."""
    have = admitted(spark, admissions)
    mark = have[-1] if have else ""
    now = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    new = []
    for bucket, path in bucket_folders(spark, root, mark):
        if bucket <= mark:
            continue
        start = _start(bucket)
        if now < start + timedelta(minutes=2 * interval_minutes):
            break
        # in the order of their times, which the file source follows
        files.put_json(spark, f"{admissions.rstrip('/')}/{bucket}.json", {"bucket": bucket, "files": files.files_below(spark, path, _SUFFIXES)},
                       int(start.timestamp() * 1000))
        new.append(bucket)
    return new


def overtaken(spark: SparkSession, root: str, admissions: str) -> list[tuple[str, list[str]]]:
    """Buckets behind the mark with the files that no admission names."""
    have = admitted(spark, admissions)
    out = []
    for bucket, path in bucket_folders(spark, root):
        if have and bucket <= have[-1]:
            known = files.get_json(spark, f"{admissions.rstrip('/')}/{bucket}.json")["files"] if bucket in have else []
            left = sorted(set(files.files_below(spark, path, _SUFFIXES)) - set(known))
            if left:
                out.append((bucket, left))
    return out


def stream_admissions(spark: SparkSession, admissions: str) -> DataFrame:
    """``bucket, files``: a stream of admissions, one a trigger."""
    return (spark.readStream.schema("bucket string, files array<string>").option("maxFilesPerTrigger", 1)
            .option("pathGlobFilter", "*.json").json(admissions))
