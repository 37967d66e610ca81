"""Readers and writers of entity files, exports and archives."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructField, StructType, StringType


def read_entities(spark: SparkSession, path: str, kind: str, schema: StructType, multiline: bool = True) -> DataFrame:
    """One JSON object a file ``{kind}_*.json``, with ``arrival`` (the file's path) and ``_corrupt_record`` for what isn't such an object."""
    full = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    reader = spark.read.schema(full).option("multiLine", multiline).option("pathGlobFilter", f"{kind}_*.json").option("mode", "PERMISSIVE")
    return reader.json(path).withColumn("arrival", F.col("_metadata.file_path"))


def write_entities(df: DataFrame, path: str, checks: Column, key: str) -> DataFrame:
    """Write records as JSON lines and give (key, problems) of those that break a check; they are written all the same."""
    df.write.mode("overwrite").json(path)
    return df.select(key, checks.alias("problems")).filter(F.size("problems") > 0)


def write_through(df: DataFrame, handler: Callable[[DataFrame], None] | None, path: str) -> None:
    """Hand the records to a handler, or write them as JSON."""
    if handler is not None:
        handler(df)
    else:
        df.write.mode("append").json(path)


def archive(df: DataFrame, path: str, by: tuple[str, ...] = ("jurisdiction", "run_ts")) -> None:
    df.write.mode("append").partitionBy(*by).json(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in an order that the seed and the key decide: a repeatable random sample."""
    return df.orderBy(F.sha2(F.concat(F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(n)


def flat_yaml(text: str) -> dict[str, object]:
    """A record of scalars, lists of scalars and lists of flat records; deeper nesting needs a full parser."""
    def scalar(x: str):
        x = x.strip()
        if x in ("", "null", "~"):
            return None
        if x in ("true", "false"):
            return x == "true"
        if x[0] == x[-1] and x[0] in "'\"" and len(x) > 1:
            return x[1:-1]
        if x in ("[]", "{}"):
            return [] if x == "[]" else {}
        return x

    out: dict[str, object] = {}
    key = None
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#") or line.strip() == "---":
            continue
        body = line.strip()
        if not line[0].isspace() and not body.startswith("- "):
            key, _, value = body.partition(":")
            out[key] = scalar(value)
        elif body.startswith("- "):
            items = out.setdefault(key, []) or []
            name, sep, value = body[2:].partition(": ")
            items.append({name: scalar(value)} if sep or body.endswith(":") else scalar(body[2:]))
            out[key] = items
        else:
            name, _, value = body.partition(":")
            held = out.get(key)
            if isinstance(held, list) and held and isinstance(held[-1], dict):
                held[-1][name] = scalar(value)
            else:
                inner = held if isinstance(held, dict) else {}
                inner[name] = scalar(value)
                out[key] = inner
    return out


def read_yaml(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One record a file, as columns of ``schema``; ``unknown`` names the keys that aren't in it (they are forbidden)."""
    fields = [x.strip().split()[0] for x in _top_level(schema)]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for pdf in batches:
            rows = [flat_yaml(x) for x in pdf["value"]]
            yield pd.DataFrame({"path": pdf["path"], "record": [json.dumps({k: r.get(k) for k in fields}, default=str) for r in rows],
                                "unknown": [sorted(set(r) - set(fields)) for r in rows]})

    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    parsed = text.mapInPandas(parse, "path string, record string, unknown array<string>")
    return parsed.withColumn("r", F.from_json("record", schema)).select("path", "unknown", "r.*")


def _top_level(schema: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[at:i])
            at = i + 1
    return [*out, schema[at:]]


def to_yaml(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, document): records as text, the id first, empty values left out."""
    parts = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in columns]
    return df.select(key, F.concat(F.lit(f"{key}: "), F.col(key).cast("string"), F.lit("\n"), F.array_join(F.array_compact(F.array(*parts)), "\n"), F.lit("\n")).alias("document"))


def numbered_districts(df: DataFrame, chamber: str, seats: str) -> DataFrame:
    """A row for each of the districts 1 to ``seats`` of every chamber."""
    return df.select(chamber, F.explode(F.sequence(F.lit(1), F.col(seats).cast("int"))).alias("district")).withColumn("district", F.col("district").cast("string"))


def bootstrap(existing: DataFrame, generated: DataFrame, key: list[str]) -> DataFrame:
    """Dimension rows that aren't there yet, each once: run again, nothing is added."""
    return generated.dropDuplicates(key).join(existing.select(*key), key, "left_anti")


def join_feeds(base: DataFrame, feeds: dict[str, DataFrame], key: str) -> DataFrame:
    """Feeds about the same people put beside each other."""
    out = base
    for feed in feeds.values():
        out = out.join(feed, key, "left")
    return out


class ScraperSource(DataSource):
    """A generator of records as a source: option ``module`` names ``package:function``, called with the number of its part.

    ``spark.read.format("scraper").option("module", "pkg:fn").option("parts", 4).schema(...).load()``
    """

    @classmethod
    def name(cls) -> str:
        return "scraper"

    def schema(self) -> str:
        return self.options.get("schema", "record string")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ScraperReader(self.options.get("module", ""), int(self.options.get("parts", "1")), schema.fieldNames())


class _ScraperReader(DataSourceReader):
    def __init__(self, module: str, parts: int, names: list[str]):
        self.module, self.parts, self.names = module, parts, names

    def partitions(self):
        return [InputPartition(i) for i in range(self.parts)]

    def read(self, partition: InputPartition):
        import importlib

        package, _, function = self.module.partition(":")
        for record in getattr(importlib.import_module(package), function)(partition.value):
            yield tuple(record.get(n) for n in self.names)


def numbers(part: int):
    """The smallest generator a source can name: two records a part."""
    for n in range(2):
        yield {"part": str(part), "n": str(n)}
