"""Writing the cleansed table by year and month, whole, appended or merged."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import storage
from tillroll.operators.cleansing import keep_max
from tillroll.operators.evolution import evolved, fitted
from tillroll.operators.gates import append_gate
from tillroll.schema import CLEANSED_SCHEMA, PERIOD, STORED_KEYS, STORED_QUANTITY
from tillroll.sinks import key_index, settling, totals
from tillroll.sources.files import literal_path
from tillroll.sources.tables import read_table, record_schema, table_schema

LAYOUTS = ("clustered", "rebalance", "as_is")
FILE_BYTES = 128 << 20  # what a file should hold at least, as far as its month goes
SPARE_FILES = 16  # files that a month may have beyond that before it is packed
_BINARY_FILE = T.StructType(  # fixed values: columns of Spark's binary file source
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
_PENDING = "_pending_merge"  # hidden from readers by its leading underscore
_DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder for NULL


def laid_out(df: DataFrame, layout: str = "rebalance") -> DataFrame:
    """Arrange rows for a write by year and month.

    ``rebalance`` brings a month's rows together and lets adaptive execution cut large months
    into, and join small months up to, tasks of ``advisoryPartitionSizeInBytes``: no task
    gets a whole month, and there are not (tasks x months) files. ``as_is`` saves that shuffle;
    right where rows are of few months, such as a monthly load. Without adaptive execution nothing
    could cut a large month, so ``rebalance`` is an error then.

    ``clustered`` also orders a month's rows by order id: tasks are ranges of month and id, so a
    large month is cut by id, and files and row groups hold narrow ranges of ids. Reads that ask for
    some ids, as merges do, skip the others. The ranges come from a sample, which computes the
    last stage of ``df`` twice.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if layout == "as_is":
        return df
    if layout == "clustered":
        return settling.clustered(df)
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("layout 'rebalance' needs spark.sql.adaptive.enabled; or use 'as_is'")
    return df.hint("rebalance", *[F.col(c) for c in PERIOD])


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    layout: str = "rebalance",
    settle: bool = False,
) -> None:
    """Write rows partitioned by year and month; with ``settle`` only the survivor of each key.

    An append states the partitioning again: without it, Parquet files would land in the
    table's root folder, where readers do not see them. An overwrite replaces the whole table,
    whatever ``spark.sql.sources.partitionOverwriteMode`` says, and with it the schema it may have
    evolved to. The index and the totals kept beside the table end here; ``append_rows`` and
    ``upsert_rows`` keep them up.
    """
    spark = df.sparkSession
    if fmt == "parquet":
        key_index.make_void(spark, path)
        totals.make_void(spark, path)
        if mode == "overwrite":
            record_schema(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
    if not settle:
        _write(laid_out(df, layout), path, mode, fmt)
        return
    with storage.scratch_folder(spark, "apart") as scratch:
        _write(_settled(df, layout, settling.line_words(df), scratch), path, mode, fmt)


def _settled(df: DataFrame, layout: str, words: DataFrame, scratch: str) -> DataFrame:
    """``laid_out`` survivors; ``words`` are those of the rows' ids per month."""
    if layout == "clustered":
        return settling.settled(df, words, scratch)
    return laid_out(keep_max(df, STORED_KEYS, STORED_QUANTITY), layout)


def _write(rows: DataFrame, path: str, mode: str, fmt: str = "parquet") -> None:
    writer = rows.write.format(fmt).mode(mode).partitionBy(*PERIOD)
    writer = writer.option("partitionOverwriteMode", "static")
    if fmt == "delta":
        writer = writer.option("delta.columnMapping.mode", "none")
    writer.save(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return storage.has_files(spark, path)


def append_rows(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    layout: str = "clustered",
    evolve: bool = False,
    settle: bool = False,
) -> None:
    """Append cleansed rows, if their schema is the table's, or with ``evolve`` can be; with
    ``settle`` only the survivor of each key.

    Where the table has an index or totals, the rows go to scratch first, because they are used
    more than once; the index gets their ids before the table gets the rows.
    """
    spark = df.sparkSession
    exists = table_exists(spark, path)
    if evolve and fmt == "parquet":
        old = table_schema(spark, path) if exists else CLEANSED_SCHEMA
        schema = evolved(old, df.schema)
        df = fitted(df, schema)
        if exists and schema != old:
            record_schema(spark, path, schema)
    elif exists:
        schema = table_schema(spark, path) if fmt == "parquet" else CLEANSED_SCHEMA
        found = spark.read.format(fmt).load(literal_path(path)).schema if schema == CLEANSED_SCHEMA else schema
        # Partition columns are typed from folder names, so only their names are comparable.
        period = [f.name for f in found.fields if f.name in PERIOD]
        data = [f for f in found.fields if f.name not in PERIOD]
        append_gate(df, T.StructType(data + [schema[name] for name in period]))
    else:
        append_gate(df, CLEANSED_SCHEMA)
    if fmt != "parquet" or not exists:
        write_table(df, path, "append" if exists or fmt != "parquet" else "overwrite", fmt, layout, settle)
        return
    indexed, summed = key_index.is_ready(spark, path), totals.state(spark, path) is not None
    with storage.scratch_folder(spark, "incoming") as scratch:
        if not indexed and not summed:
            rows = _settled(df, layout, settling.line_words(df), scratch) if settle else laid_out(df, layout)
            _write(rows, path, "append", fmt)
            return
        incoming = storage.stored(keep_max(df, STORED_KEYS, STORED_QUANTITY) if settle else df, scratch)
        if indexed:
            key_index.add(incoming, path)
        if summed:
            totals.mark_stale(spark, path, _months(incoming))
        _write(laid_out(incoming, layout), path, "append", fmt)
    if summed:
        totals.renew(spark, path, read_table(spark, path))


def _month_number(year: int | None, month: int | None) -> int:
    return -1 if year is None or month is None else year * 100 + month


def in_months(months: Sequence[Row]) -> Column:
    """Rows of the given months; on partition columns, so other months are not read."""
    return _number().isin([_month_number(m.year, m.month) for m in months])


def _number() -> Column:
    return F.coalesce(F.col("year") * 100 + F.col("month"), F.lit(-1))


def _in_ranges(table: DataFrame, holding: Sequence[Row]) -> DataFrame:
    """Rows of the given months whose order id is within their month's range.

    Rows meet their own month only, in a join with the few months: a chain of all months' conditions
    costs their number for each row, and is too long to be compiled.
    """
    ranges = [(_month_number(m.year, m.month), m.low, m.high) for m in holding]
    own = table.sparkSession.createDataFrame(ranges, "_number int, _low long, _high long")
    order_id = F.col(STORED_KEYS[0])
    # Periods prune partitions, the range of all months prunes row groups.
    wide = order_id.between(min((m.low for m in holding), default=0), max((m.high for m in holding), default=0))
    rows = table.filter(in_months(holding)).filter(wide).join(F.broadcast(own), _number() == F.col("_number"))
    return rows.filter(order_id.between(F.col("_low"), F.col("_high"))).select(*table.columns)


_UNDATED = Row(year=None, month=None)


def _months(df: DataFrame) -> list[Row]:
    """Distinct periods: bounded by the calendar, not by the data."""
    return _in_order(df.select(*PERIOD).distinct().collect())


def _in_order(months: Iterable[Row]) -> list[Row]:
    return sorted(months, key=lambda m: _month_number(m.year, m.month))


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(k).alias(f"new_{k}") for k in STORED_KEYS])


def _same_key(rows: DataFrame, keys: DataFrame) -> list[Column]:
    # The id is never NULL here; a product can be.
    id_, product = STORED_KEYS
    return [rows[id_] == keys[f"new_{id_}"], rows[product].eqNullSafe(keys[f"new_{product}"])]


def _without(rows: DataFrame, gone: DataFrame, scratch: str) -> DataFrame:
    """Rows whose key is not among the given ones. Only rows with an id of these are moved."""
    id_, _ = STORED_KEYS
    ids = key_index.id_words(gone.select(F.col(f"new_{id_}").alias(id_)))
    named, others = settling.split_by_id(rows, settling.few_words(ids, scratch))
    named = named.join(gone, _same_key(named, gone), "left_anti")
    return named if others is None else others.unionByName(named)


def touched_months(
    incoming: DataFrame, table: DataFrame, holding: Sequence[Row] | None = None, keys: DataFrame | None = None
) -> list[Row]:
    """Months to rewrite: those of new rows, and of old rows that share a key with them.

    Rows without a date share one folder, which only grows: new ones are added to it, so it is
    rewritten only if it holds one of the keys.

    Only the key columns of the table are read, and only rows of months that the new rows do not name
    already are held against the keys. ``holding``, from the index, names the months that
    hold an order id of the new rows and the range of those ids: only these months' files are read,
    and of them the row groups within the range. Without an index, all row groups that reach
    into the range of new order ids are read. A key may be of another month than the new row, because
    the date is no part of it. ``keys`` are those to look for, if not the new rows' own.
    """
    order_id = F.col(STORED_KEYS[0])
    if holding is None:
        low, high = incoming.agg(F.min(order_id), F.max(order_id)).first()
        table = table.filter(order_id.between(low, high))
    else:
        table = _in_ranges(table, holding)
    dated = incoming.filter(~in_months([_UNDATED]))
    # These months are rewritten in any case. A row per month.
    named = dated.select(_number().alias("_named")).distinct()
    table = table.join(F.broadcast(named), _number() == F.col("_named"), "left_anti")
    # One row per key on this side, and sized by its files: broadcast only if small.
    keys = _keys(incoming) if keys is None else keys
    displaced = table.join(keys, _same_key(table, keys), "left_semi")
    return _months(dated.select(*PERIOD).unionByName(displaced.select(*PERIOD)))


def _folder_names(month: Row) -> list[str]:
    return [f"{c}={_DEFAULT_PARTITION if month[c] is None else month[c]}" for c in PERIOD]


def _month_folder(path: str, month: Row) -> str:
    return "/".join([path.rstrip("/"), *_folder_names(month)])


def upsert_rows(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    layout: str = "clustered",
    evolve: bool = False,
    withdrawn: DataFrame | None = None,
    settle: bool = False,
) -> list[Row]:
    """Merge cleansed rows into the table, keeping the largest quantity per key.

    With ``settle`` the new rows may hold several lines per key among themselves.

    Returns the months rewritten. The result is what a full load of old and new rows would
    give. Only touched months are read and rewritten; which ones, the index beside the table tells
    (``key_index``, filled by the first merge). ``withdrawn`` are keys, as rows of ``STORED_KEYS``,
    whose rows leave the table before the new ones are merged. With ``evolve`` new rows may
    have more columns and wider numbers than the table.

    On Parquet the merged months are stored beside the table and then published by moving their
    folders into the places of the old ones; months left without rows are removed, so the driver's
    work grows with the months, not with the files, and no row is written twice. A note inside the
    table says what is being published: if that dies, the next merge publishes the rest first, so no
    row is lost for good and none is stored twice. Index and totals are renewed under the same note.
    """
    spark = df.sparkSession
    schema = CLEANSED_SCHEMA
    exists = table_exists(spark, path)
    if exists and fmt == "parquet":
        _publish_pending(spark, path)
        schema = table_schema(spark, path)
    if evolve and fmt == "parquet":
        old, schema = schema, evolved(schema, df.schema)
        df = fitted(df, schema)
        if exists and schema != old:
            record_schema(spark, path, schema)
    else:
        append_gate(df, schema)
    if not exists:
        write_table(df, path, "overwrite", fmt, layout, settle)
        return []
    with storage.scratch_folder(spark, "incoming") as scratch:
        # Used three times below; written, so that it is computed once and survives lost executors.
        incoming = storage.stored(df, f"{scratch}/rows", "zstd")
        # Tasks put out a key once, so that a frequent one is not looked for by all its lines.
        keys = _keys(incoming).distinct() if settle else _keys(incoming)
        if withdrawn is not None:
            gone = storage.stored(_keys(withdrawn).distinct(), f"{scratch}/withdrawn")
            keys = storage.stored(keys.unionByName(gone).distinct(), f"{scratch}/keys")
        table = read_table(spark, path, fmt, schema)
        holding = None
        if fmt == "parquet":
            if not key_index.is_ready(spark, path):
                key_index.fill(table, path)
            ids = keys.select(F.col(f"new_{STORED_KEYS[0]}").alias(STORED_KEYS[0]))
            holding = key_index.months_holding(spark, path, ids)
        elif withdrawn is not None:
            raise ValueError("rows are withdrawn from Parquet tables only")
        months = touched_months(incoming, table, holding, keys)
        added = _UNDATED not in months and not incoming.filter(in_months([_UNDATED])).isEmpty()
        if not months and not added:
            return []
        kept = table.filter(in_months(months))
        if withdrawn is not None:
            kept = _without(kept, gone, f"{scratch}/gone_ids")
        merged = kept.unionByName(incoming)
        if fmt != "parquet":
            # A table format replaces the months in one transaction.
            predicate = " OR ".join(
                f"(year <=> {_literal(m.year)} AND month <=> {_literal(m.month)})" for m in months
            )
            merged = keep_max(merged, STORED_KEYS, STORED_QUANTITY)
            laid_out(merged, layout).write.format(fmt).mode("overwrite").option(
                "replaceWhere", predicate
            ).save(path)
            return months
        held = key_index.read_index(spark, path).filter(in_months(months)).withColumn("n_lines", F.lit(0))
        words = held.unionByName(settling.line_words(incoming)).groupBy("word", *PERIOD)
        words = words.agg(F.bit_or("bits").alias("bits"), F.sum("n_lines").alias("n_lines"))
        staged = _staging_path(path, "merged")
        _write(_settled(merged, layout, words, f"{scratch}/apart"), staged, "overwrite")
    _publish(spark, path, staged, months, added)
    return months


def _staging_path(path: str, name: str) -> str:
    """Beside the table, so that what is staged can be moved into it."""
    return f"{path.rstrip('/')}_{name}-{storage.fresh_name()}"


def _publish(spark: SparkSession, path: str, staged: str, months: Sequence[Row], undated: bool) -> None:
    note = {"staged": staged, "months": [[m.year, m.month] for m in months], "undated": undated}
    # Months without a folder now have no rows left; later on, their folder may have been moved.
    note["left"] = [[m.year, m.month] for m in _staged_months(spark, staged, months)]
    storage.write_text(spark, f"{path.rstrip('/')}/{_PENDING}", json.dumps(note))
    _publish_pending(spark, path)


def crowded_months(
    spark: SparkSession, path: str, file_bytes: int = FILE_BYTES, spare_files: int = SPARE_FILES
) -> DataFrame:
    """``year, month, n_files, n_bytes`` of months whose files are more, by ``spare_files`` at least,
    than their bytes fill. File names and lengths are read, no file is opened."""
    period = T.StructType([T.StructField(c, T.IntegerType()) for c in PERIOD])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = files.schema(T.StructType([*_BINARY_FILE.fields, *period.fields])).load(literal_path(path))
    per_month = files.select("length", *PERIOD).groupBy(*PERIOD).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes")
    )
    return per_month.filter(F.col("n_files") >= F.ceil(F.col("n_bytes") / file_bytes) + spare_files)


def pack_table(
    spark: SparkSession, path: str, file_bytes: int = FILE_BYTES, spare_files: int = SPARE_FILES
) -> list[Row]:
    """Rewrite months that consist of many small files, as appends leave them; returns them.

    Packed months are clustered again. They are published under the same note as a merge, so one
    that dies is finished by the next merge or packing.
    """
    if not table_exists(spark, path):
        return []
    with storage.shuffles_freed(spark):
        _publish_pending(spark, path)
        months = _in_order(crowded_months(spark, path, file_bytes, spare_files).select(*PERIOD).collect())
        if months:
            schema = table_schema(spark, path)
            staged = _staging_path(path, "packed")
            rows = read_table(spark, path, schema=schema).filter(in_months(months))
            _write(laid_out(rows, "clustered"), staged, "overwrite")
            _publish(spark, path, staged, months, False)
    return months


def _publish_pending(spark: SparkSession, path: str) -> None:
    """Replace the noted months by their stored rows; nothing to do without a note.

    Every step can be repeated: a month's rows are where they were stored or in their place, and
    the note says which months have any.
    """
    note_path = f"{path.rstrip('/')}/{_PENDING}"
    note = storage.read_text(spark, note_path)
    if note is None:
        return
    noted = json.loads(note)
    staged, undated = noted["staged"], noted["undated"]
    changed = [Row(year=year, month=month) for year, month in noted["months"]]
    schema = table_schema(spark, path)
    if "left" not in noted:
        # Noted by an earlier version, which staged rows elsewhere.
        beside = _staging_path(path, "merged")
        _write(read_table(spark, staged, schema=schema), beside, "overwrite")
        _publish(spark, path, beside, changed, undated)
        storage.delete(spark, staged)
        return
    left = [Row(year=year, month=month) for year, month in noted["left"]]
    summed = totals.mark_stale(spark, path, [*changed, _UNDATED] if undated else changed)
    indexed = key_index.is_ready(spark, path)
    if undated:
        new = read_table(spark, staged, schema=schema).filter(in_months([_UNDATED]))
        if indexed:
            key_index.add(new, path)
        _add_undated(new, path, schema)
    for month in changed:
        if month not in left:
            storage.delete(spark, _month_folder(path, month))
    storage.move_folders(spark, {_month_folder(staged, m): _month_folder(path, m) for m in left})
    spark.catalog.refreshByPath(path)
    if indexed and left:
        key_index.replace_months(read_table(spark, path, schema=schema).filter(in_months(left)), path)
    if summed:
        totals.renew(spark, path, read_table(spark, path, schema=schema))
    storage.delete(spark, note_path, staged)


def _staged_months(spark: SparkSession, staged: str, months: Sequence[Row]) -> list[Row]:
    """Those of the given months that have a folder: a look per year."""
    years = {year for year, _ in map(_folder_names, months)}
    there = {(year, name) for year in years for name in storage.names(spark, f"{staged}/{year}")}
    return [month for month in months if tuple(_folder_names(month)) in there]


def _add_undated(rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Add rows without a date to their folder, those left out that a publishing before added."""
    id_, product = STORED_KEYS
    there = read_table(rows.sparkSession, path, schema=schema).filter(in_months([_UNDATED]))
    keys = there.select(F.col(id_).alias("_id"), F.col(product).alias("_product"))
    same = (F.col(id_) == F.col("_id")) & F.col(product).eqNullSafe(F.col("_product"))
    new = rows.join(keys, same, "left_anti")
    new.write.mode("append").partitionBy(*PERIOD).parquet(path)


def _literal(value: int | None) -> str:
    return "NULL" if value is None else str(value)
