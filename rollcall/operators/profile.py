"""Column profiles from columnar-file footers, scanning only the chunks whose statistics don't suffice."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rollcall.sources.parquet_pages import dictionary

#: Row groups are spread over at most so many tasks.
MAX_TASKS = 20_000
_COUNTS = "grp long, column_name string, value string, n long, rows long, source string"


def value_counts(spark: SparkSession, path: str, group: str, columns: list[str] | None = None, counted: list[str] | None = None, patterns: dict[str, str] | None = None) -> DataFrame:
    """The values of each column (None: all of the schema) in each group: (grp, column_name, value, n, rows, source), a part a chunk.

    ``n`` is how often a value occurs in the chunk, null where only the chunk's distinct values are known; the row of the null
    value (always there) has the chunk's ``rows`` and its exact nulls. ``source`` is where that comes from: ``footer``, ``dictionary`` or ``data``.

    Footers are read first, one task a file. A row group is pure if its statistics give one value of ``group`` and no
    null; then its nulls, and the value of chunks with equal extrema, come from the footer. Of the others, the dictionary
    tells the distinct values of numbers and texts if all data pages use it: enough for columns that aren't ``counted`` (None: all
    are), unless one of its values violates the column's pattern, whose rows must be counted. Only what is left is
    decoded. Rows with a null group are a group of their own. Values are given as text, maps, structs and arrays as JSON with
    sorted keys.
    """
    columns = spark.read.parquet(path).columns if columns is None else columns
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path"))

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            for p in batch.column(0).to_pylist():
                with _opened(p) as f:
                    n = pq.ParquetFile(f).metadata.num_row_groups
                yield pa.record_batch({"path": pa.array([p] * n, pa.string()), "row_group": pa.array(range(n), pa.int32())})

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from _chunk_counts(p, i, group, columns, counted, patterns or {})

    units = files.mapInArrow(footers, "path string, row_group int")
    # the units are a few bytes each but stand for whole row groups: a fixed number of tasks, not one by their size
    tasks = min(MAX_TASKS, max(spark.sparkContext.defaultParallelism, 4 * files.count()))
    return units.repartition(tasks).mapInArrow(counts, _COUNTS)


def _opened(path: str):
    from pyarrow import fs

    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem().open_input_file(path)
    if path.startswith("file:"):
        from urllib.parse import unquote, urlparse

        return fs.LocalFileSystem().open_input_file(unquote(urlparse(path).path))
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _chunk_counts(path: str, row_group: int, group: str, columns: list[str], counted: list[str] | None, patterns: dict[str, str]) -> Iterator[pa.RecordBatch]:
    import re

    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    def out(g, column, values, n, rows, source):
        m = len(values)
        return pa.record_batch({"grp": pa.array(g if isinstance(g, list) else [g] * m, pa.int64()), "column_name": pa.array([column] * m, pa.string()),
                                "value": pa.array(values, pa.string()), "n": pa.array(n, pa.int64()), "rows": pa.array(rows, pa.int64()), "source": pa.array([source] * m, pa.string())})

    def whole(g, column, found, rows, source):
        """Values with their counts (null: not known), the null value first."""
        nulls = found.pop(None, 0) or 0
        return out(g, column, [None, *found], [nulls, *found.values()], [rows] + [None] * len(found), source)

    with _opened(path) as f:
        file = pq.ParquetFile(f)
        kinds = {x.name: x.type for x in file.schema_arrow}
        text = [c for c in columns if c in kinds and pa.types.is_string(kinds[c])]
        meta = file.metadata.row_group(row_group)
        rows = meta.num_rows
        if not rows:
            return
        chunks = {meta.column(j).path_in_schema: meta.column(j) for j in range(meta.num_columns)}
        g = chunks[group].statistics if group in chunks else None
        pure = g is not None and g.has_min_max and g.has_null_count and g.null_count == 0 and g.min == g.max
        reader = None
        for column in columns:
            c = chunks.get(column)
            s = c.statistics if c is not None else None
            if pure and s is not None and s.has_null_count:
                if s.null_count == rows:
                    yield whole(g.min, column, {None: rows}, rows, "footer")
                    continue
                # extrema of text may be cut short in footers, those of whole numbers are exact
                if s.has_min_max and s.min == s.max and isinstance(s.min, int) and not isinstance(s.min, bool):
                    yield whole(g.min, column, {None: s.null_count, str(s.min): rows - s.null_count}, rows, "footer")
                    continue
                kind = kinds[column]
                if counted is not None and column not in counted and (pa.types.is_integer(kind) or pa.types.is_string(kind)):
                    values = dictionary(f, c, kind)
                    pattern = patterns.get(column, "").replace(r"\z", r"\Z")
                    if values is not None and all(re.search(pattern, v) for v in values if isinstance(v, str)):
                        yield whole(g.min, column, {None: s.null_count} | {str(v): None for v in values}, rows, "dictionary")
                        continue
            reader = reader or pq.ParquetFile(f, read_dictionary=text, metadata=file.metadata)  # dictionaries stay dictionaries, indices are counted
            if pure:
                data = _flat(reader.read_row_group(row_group, columns=[column]).column(0)).combine_chunks()
                found = pc.value_counts(data)
                values = found.field("values")
                if pa.types.is_dictionary(values.type):
                    values = values.dictionary_decode()
                yield whole(g.min, column, dict(zip(pc.cast(values, pa.string()).to_pylist(), found.field("counts").to_pylist(), strict=True)), rows, "data")
            else:
                table = reader.read_row_group(row_group, columns=list(dict.fromkeys([group, column])))
                c = _flat(table.column(column))
                c = pc.cast(c.cast(c.type.value_type) if pa.types.is_dictionary(c.type) else c, pa.string())
                both = pa.table({"g": table.column(group), "v": c}).group_by(["g", "v"]).aggregate([([], "count_all")])
                by: dict = {}
                for x, v, n in zip(both.column("g").to_pylist(), both.column("v").to_pylist(), both.column("count_all").to_pylist(), strict=True):
                    by.setdefault(x, {})[v] = n
                for x, found in by.items():
                    yield whole(x, column, found, sum(found.values()), "data")


def _flat(data: pa.ChunkedArray) -> pa.ChunkedArray:
    """Maps, structs and arrays as canonical text, other columns as they are."""
    import json

    if not pa.types.is_nested(data.type):
        return data

    def plain(v, kind):
        if v is None:
            return None
        if pa.types.is_map(kind):
            return [[plain(k, kind.key_type), plain(x, kind.item_type)] for k, x in v]
        if pa.types.is_struct(kind):
            return {f.name: plain(v[f.name], f.type) for f in kind}
        return [plain(x, kind.value_type) for x in v] if pa.types.is_nested(kind) else v

    def canonical(v):
        v = plain(v, data.type)
        if v is not None and pa.types.is_map(data.type):
            v = sorted(v, key=lambda e: json.dumps(e, default=str, ensure_ascii=False))
            if all(isinstance(k, str) for k, _ in v) and len({k for k, _ in v}) == len(v):
                v = dict(v)
        return None if v is None else json.dumps(v, default=str, ensure_ascii=False, sort_keys=True)

    return pa.chunked_array([pa.array([canonical(v) for v in c.to_pylist()], pa.string()) for c in data.chunks], pa.string())


def profile(counts: DataFrame, numeric: list[str], valid_range: tuple[int, int], patterns: dict[str, str] | None = None, whole: list[str] | None = None) -> DataFrame:
    """One row a group and column: rows, nulls, distinct values, extrema, mean parts in range, pattern violations.

    ``rows``, ``nulls``, ``n_distinct`` (non-null), ``low``/``high`` (columns of whole numbers: ``numeric`` and ``whole``),
    ``low_text``/``high_text`` (all columns: those by value, others by code point), ``n_in``/``sum_in`` over the values of
    ``numeric`` in ``valid_range``, ``n_out`` (numeric values outside it), ``n_bad`` (values that don't match the
    column's pattern; nulls match), ``chunks`` and how many of them were ``scanned`` beyond footer and dictionary.
    ``counts`` must have been taken with ``numeric`` among the counted columns and with ``patterns``.
    """
    low, high = valid_range
    per_value = counts.groupBy("grp", "column_name", "value").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.count("rows").alias("chunks"), F.count_if(F.col("rows").isNotNull() & (F.col("source") == "data")).alias("scanned"))
    number = F.when(F.col("column_name").isin(numeric), F.col("value").try_cast("long"))
    ordered = F.when(F.col("column_name").isin([*numeric, *(whole or [])]), F.col("value").try_cast("long"))
    ranked = F.when(F.col("value").isNotNull(), F.struct(ordered.alias("o"), F.col("value")))
    inside = number.between(low, high)
    bad: Column = F.lit(False)
    for column, pattern in (patterns or {}).items():
        bad = bad | ((F.col("column_name") == column) & ~F.col("value").rlike(pattern))
    return per_value.groupBy("grp", "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("chunks").alias("chunks"), F.sum("scanned").alias("scanned"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("n_distinct"), F.min(ordered).alias("low"), F.max(ordered).alias("high"),
        F.min(ranked)["value"].alias("low_text"), F.max(ranked)["value"].alias("high_text"),
        F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias("n_in"),
        F.coalesce(F.sum(F.when(inside, F.col("n") * number)), F.lit(0)).alias("sum_in"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_out"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull() & bad, F.col("n"))), F.lit(0)).alias("n_bad"))


def with_changes(profiled: DataFrame) -> DataFrame:
    """The profile with rates and means, and with those of the group before (``grp`` - 1) as ``before`` and their change.

    ``before`` is null for the first group, for a group whose predecessor is missing and for the null group; so are
    ``null_rate_change``, ``n_distinct_change``, ``mean_change`` (of the values in range) and ``n_bad_change``, and
    ``low_change``/``high_change`` of whole numbers; ``range_changed`` tells of all columns whether an extremum moved.
    """
    over = Window.partitionBy("column_name").orderBy("grp")
    rated = profiled.withColumns({"null_rate": F.col("nulls") / F.col("rows"), "mean": F.when(F.col("n_in") > 0, F.col("sum_in") / F.col("n_in"))})
    kept = ["grp", "rows", "nulls", "n_distinct", "low", "high", "low_text", "high_text", "n_in", "sum_in", "n_bad", "null_rate", "mean"]
    last = F.lag(F.struct(*kept)).over(over)
    rated = rated.withColumn("before", last).withColumn("before", F.when(F.col("before.grp") == F.col("grp") - 1, F.col("before")))
    changes = {f"{c}_change": F.col(c) - F.col(f"before.{c}") for c in ("null_rate", "n_distinct", "low", "high", "mean", "n_bad")}
    moved = ~(F.col("low_text").eqNullSafe(F.col("before.low_text")) & F.col("high_text").eqNullSafe(F.col("before.high_text")))
    return rated.withColumns(changes | {"range_changed": F.when(F.col("before").isNotNull(), moved)})


def findings(profiled: DataFrame, numeric: list[str], patterned: list[str]) -> DataFrame:
    """(grp, column_name, finding): what is wrong in a load, or differs from the load before (grp - 1).

    ``value_range``, ``pattern``; against the load before: ``null_rate`` (share of nulls differs by more than
    0.1), ``distinct`` (fewer than half as many), ``shift`` (mean in range more than twice or less than half).
    All comparisons are of whole numbers; a load without values in range has no mean and no shift. Takes a profile
    with or without its changes.
    """
    profiled = profiled if "before" in profiled.columns else with_changes(profiled)
    dec = lambda c: F.col(c).cast("decimal(38,0)")
    num = F.col("column_name").isin(numeric)
    has = num & F.col("before").isNotNull()
    found = {
        "value_range": num & (F.col("n_out") > 0),
        "pattern": F.col("column_name").isin(patterned) & (F.col("n_bad") > 0),
        "null_rate": has & (F.abs(dec("nulls") * dec("before.rows") - dec("before.nulls") * dec("rows")) * 10 > dec("rows") * dec("before.rows")),
        "distinct": has & (F.col("n_distinct") * 2 < F.col("before.n_distinct")),
        "shift": has & (F.col("n_in") > 0) & (F.col("before.n_in") > 0)
        & ((dec("sum_in") * dec("before.n_in") > dec("before.sum_in") * dec("n_in") * 2) | (dec("sum_in") * dec("before.n_in") * 2 < dec("before.sum_in") * dec("n_in"))),
    }
    kinds = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in found.items()]))
    return profiled.select("grp", "column_name", F.explode(kinds).alias("finding"))
