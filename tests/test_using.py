"""Log tables declared by SQL text: reads, pushed conditions, inserts."""
import datetime as dt
import uuid

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from shardlake.functions.parse import parse_value
from shardlake.functions.text import value_text
from shardlake.functions.values import texts, typed
from shardlake.model import cursor_of
from shardlake.sources.fixtures import events_log_root, events_log_store
from shardlake.sources.logstore import read_log_store
from shardlake.sources.manifest import Manifest, set_status, settle
from shardlake.sources.positions_source import Store, stream_groups
from shardlake.sources.using import LogTableReader, LogTableWriter, register_format
from shardlake.sql import register_log_table

SF = "/root/testdata/sf0.001"
EDGES = ["", " 12 ", "+5", "-", "-7", "1.5", "128", "32768", "2147483648", "9223372036854775808", "yes", "TRUE", "False", "NaN", "nan", "-Infinity",
         "1e3", "1e400", "-1E400", ".5", "5.", "3f", "0x1p3", "0x1.8p1d", "1.005", "-1.005", "123.45", "12345678.9", "1e-400", "19723", "-1",
         "2024-01-01", "2024-1-1", "2024-02-30", "0000-03-01", "9999-12-31", "45296789", "12:34", "1704067200000", "9223372036854775",
         "9223372036854776", "2024-01-01T00:00", "2024-01-01T23:59:59.123456789", "2024-01-01T24:00", "2024-01-01T00:60", "2024-01-01 00:00:00.5",
         "2024-1-2 3:04:05", "2024-13-01 00:00:00", "2024-01-01T00:00:00Z", "0000-01-01T00:00", "é", "İ", None]
TYPES = ["string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(5,2)", "decimal(38,10)", "date", "timestamp_ntz",
         "timestamp", "binary"]


@pytest.fixture()
def sql(spark):
    register_format(spark)
    return spark.sql


def view(sql, columns, **options):
    name = f"v_{uuid.uuid4().hex}"
    given = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    sql(f"CREATE TEMPORARY VIEW {name} ({columns}) USING shardlake OPTIONS ({given})")
    return name


@pytest.mark.parametrize("name", TYPES)
def test_texts_are_parsed_as_in_the_engine(spark, name):
    """The rules for single texts give what the column expressions give."""
    dtype = spark.createDataFrame([], f"c {name}").schema[0].dataType
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(EDGES)], "i int, s string")
    there = rows.select("i", parse_value(F.col("s"), dtype, "c", False).alias("c")).orderBy("i").toArrow()["c"].combine_chunks()
    here = typed(pa.array(EDGES, pa.string()), dtype, "c", False)
    if pa.types.is_timestamp(here.type):
        here, there = here.cast(pa.int64()), there.cast(pa.int64())
    if pa.types.is_date(here.type):
        here, there = here.cast(pa.int32()), there.cast(pa.int32())
    for s, a, b in zip(EDGES, here.to_pylist(), there.to_pylist()):
        assert a == b or a != a and b != b, s


def test_a_text_that_is_not_accepted_raises():
    with pytest.raises(ValueError, match="Failed to parse field 'c' value 'x' as INT"):
        typed(pa.array(["1", "x"]), T.IntegerType(), "c", True)


def test_values_are_written_as_in_the_engine(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (true, 1Y, -5L, 1.50BD, DATE'2024-02-01', TIMESTAMP_NTZ'2024-01-01 00:00:00', X'61'),
        (false, NULL, 0L, -0.01BD, DATE'0500-02-01', TIMESTAMP_NTZ'1969-12-31 23:59:58.5', NULL),
        (NULL, 2Y, 7L, NULL, NULL, TIMESTAMP_NTZ'2024-01-01 10:00:01.000001', X'') AS t(a, b, c, d, e, f, g)""")
    there = df.select(*[value_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]).collect()
    rows = df.toArrow()
    for f in df.schema.fields:
        assert texts(rows[f.name].combine_chunks(), f.dataType) == [r[f.name] for r in there]


COLUMNS = ("event_id BIGINT, user_id INT, value DOUBLE, ok BOOLEAN, day DATE, at TIMESTAMP_NTZ, attempt TINYINT, absent STRING, "
           "__time__ TIMESTAMP_NTZ, __shard__ INT, __topic__ STRING, __source__ STRING, __cursor__ STRING")


@pytest.mark.parametrize("more", [{}, {"scan.startup.mode": "1704499200", "stop.time": "1705708800"}, {"scan.startup.mode": "latest"}])
def test_a_declared_table_reads_as_its_view(spark, sql, more):
    options = {"project": events_log_root(spark, SF), "logstore": "events-.*", "logstore.pattern": "true", **more}
    here = sql(f"SELECT * FROM {view(sql, COLUMNS, **options)}")
    there = register_log_table(spark, f"v_{uuid.uuid4().hex}", COLUMNS, options)
    assert here.schema == there.schema
    assert here.exceptAll(there).isEmpty() and there.exceptAll(here).isEmpty()
    assert here.isEmpty() == (more.get("scan.startup.mode") == "latest")


def test_conditions_leave_out_files_and_row_groups(spark, sql):
    root = events_log_root(spark, SF)
    schema = spark.createDataFrame([], COLUMNS).schema

    def planned(*filters):
        reader = LogTableReader(schema, {"project": root, "logstore": "events-click"})
        assert list(reader.pushFilters(list(filters))) == list(filters)
        return reader, reader.partitions()

    assert {p.shard for p in planned()[1]} == {0, 1, 2, 3}
    assert {p.shard for p in planned(EqualTo(("__shard__",), 2))[1]} == {2}
    assert {p.shard for p in planned(GreaterThan(("__shard__",), 1), In(("__shard__",), (0, 3)))[1]} == {3}
    cursors = events_log_store(spark, SF).where("seq IN (1, 2)").select(cursor_of("seq").alias("c")).distinct().collect()
    _, parts = planned(In(("__cursor__",), tuple(r["c"] for r in cursors)), EqualTo(("__shard__",), 0))
    assert [(p.lo, p.hi) for p in parts] == [(1, 3)]
    assert planned(EqualTo(("__cursor__",), "no cursor"))[1] == []
    reader, parts = planned(EqualTo(("__topic__",), "web"))
    assert {t for p in parts for b in reader.read(p) for t in b["__topic__"].to_pylist()} == {"web"}
    name = view(sql, COLUMNS, project=root, logstore="events-click")
    got = sql(f"SELECT count(*) AS n FROM {name} WHERE `__shard__` = 1 AND `__topic__` = 'app'").first()["n"]
    assert got == events_log_store(spark, SF).where("logstore = 'events-click' AND shard = 1").agg(F.sum(F.size("logs"))).first()[0]


def seqs(groups, shard):
    return sorted(r["seq"] for r in groups.where(F.col("shard") == shard).select("seq").collect())


def test_inserts_by_sql_are_read_at_once_and_get_positions(spark, sql, scratch):
    """Two INSERTs: rows are there before any Spark job opened the store, and
    their positions stay what they were when it is settled."""
    root, columns = f"{scratch}/store", "id BIGINT, v STRING, __topic__ STRING, __hash_key__ STRING"
    sink = view(sql, columns, project=root, logstore="out", **{"sink.shards": "3", "sink.topic": "t"})
    read = view(sql, "id BIGINT, v DECIMAL(10,3), __topic__ STRING, __shard__ INT, __cursor__ STRING", project=root, logstore="out")
    for part in (0, 1):
        sql(f"""INSERT INTO {sink} SELECT id, CAST(id / 8 AS DOUBLE), IF(id % 5 = 0, NULL, 'x'), IF(id % 3 = 0, NULL, md5(CAST(id AS STRING)))
                FROM range(0, 1000, 1, 4) WHERE id % 2 = {part}""")
    staged = sorted(sql(f"SELECT * FROM {read}").collect())
    assert [(r["id"], float(r["v"]), r["__topic__"]) for r in staged] == [(i, i / 8, "x" if i % 5 else "t") for i in range(1000)]
    before = Store(root)
    assert {f["path"] for s in before.shards(lambda n: True).values() for f in s["files"]} and not (before.root + "/logstore=out") in {
        f.path for f in before.fs.get_file_info([before.root + "/logstore=out"]) if f.type.name != "NotFound"}
    out = []
    q = (stream_groups(spark, {"project": root, "logstore": "out"}).writeStream.foreachBatch(lambda b, i: out.extend(b.select("shard", "seq").collect()))
         .option("checkpointLocation", f"{scratch}/checkpoint").trigger(processingTime="0 seconds").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    groups = read_log_store(spark, root, "out")     # settles
    for shard in range(3):
        end = len(seqs(groups, shard))
        assert end and seqs(groups, shard) == list(range(end)) == sorted(r["seq"] for r in out if r["shard"] == shard)
    assert sorted(sql(f"SELECT * FROM {read}").collect()) == staged
    assert groups.where(F.col("cursor") != cursor_of("seq")).isEmpty() and groups.where("cursor_time IS NULL").isEmpty()
    ends = {r["shard"]: r["end_seq"] for r in Manifest.open(spark, root).ends().collect()}
    assert ends == {s: len(seqs(groups, s)) for s in range(3)}


def test_two_writers_at_the_same_time_get_positions_of_their_own(spark, scratch):
    root, schema = f"{scratch}/store", T.StructType([T.StructField("id", T.LongType())])
    options = {"project": root, "logstore": "out"}
    writers = [LogTableWriter(schema, options) for _ in range(2)]
    done = [w.write(iter([pa.RecordBatch.from_pydict({"id": [i]}, schema=pa.schema([("id", pa.int64())]))])) for i, w in enumerate(writers)]
    stale = writers[1].store.entries
    first = []
    writers[1].store.entries = lambda: first.append(1) or (writers[0].commit([done[0]]) if len(first) == 1 else None) or stale()
    writers[1].commit([done[1]])        # the other commits between its look and its rename
    settle(spark, root)
    assert len(first) == 2 and seqs(read_log_store(spark, root), 0) == [0, 1]


def test_a_failed_insert_leaves_nothing_and_closed_shards_stay_closed(spark, sql, scratch):
    root = f"{scratch}/store"
    sink = view(sql, "id BIGINT, __hash_key__ STRING", project=root, logstore="out", **{"sink.shards": "2"})
    with pytest.raises(PySparkException, match="Not a hash key"):
        sql(f"INSERT INTO {sink} SELECT id, IF(id = 99, 'zz', NULL) FROM range(100)")
    assert Manifest.open(spark, root).version == 0
    sql(f"INSERT INTO {sink} SELECT id, NULL FROM range(100)")
    set_status(spark, root, spark.createDataFrame([("out", 0, "readonly")], "logstore string, shard int, status string"))
    end = len(seqs(read_log_store(spark, root), 0))
    sql(f"INSERT INTO {sink} SELECT id, '00' FROM range(100)")
    assert len(seqs(read_log_store(spark, root), 0)) == end
    with pytest.raises(PySparkException):
        sql(f"INSERT OVERWRITE TABLE {sink} SELECT 1, NULL")


def test_declarations_are_checked(spark, sql, scratch):
    with pytest.raises(PySparkException, match="Unsupported option"):
        sql(f"SELECT * FROM {view(sql, 'a STRING', project=scratch, logstore='x', nonsense='1')}").collect()
    with pytest.raises(PySparkException, match="Unsupported field type"):
        sql(f"SELECT * FROM {view(sql, 'a ARRAY<INT>', project=scratch, logstore='x')}").collect()
    with pytest.raises(PySparkException, match="declare the column STRING"):
        sql(f"INSERT INTO {view(sql, 'a DOUBLE', project=scratch, logstore='x')} SELECT 1.5D")


def test_write_times_never_fall(spark, scratch):
    """An insert behind groups of a later write time takes that time."""
    root, schema = f"{scratch}/store", T.StructType([T.StructField("id", T.LongType())])
    late = dt.datetime(2999, 1, 1)
    from shardlake.sources.logstore import write_log_store
    write_log_store(events_log_store(spark, SF).where("logstore = 'events-click' AND shard = 0 AND seq < 2")
                    .withColumn("cursor_time", F.lit(late).cast("timestamp_ntz")), root)
    w = LogTableWriter(schema, {"project": root, "logstore": "events-click"})
    w.commit([w.write(iter([pa.RecordBatch.from_pydict({"id": [1]}, schema=pa.schema([("id", pa.int64())]))]))])
    assert [(r["seq"], r["cursor_time"]) for r in read_log_store(spark, root).orderBy("seq").collect()] == [(i, late) for i in range(3)]
