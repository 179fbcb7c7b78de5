import pytest
from pyspark.sql import functions as F

from tidewell.operators.clustered import ClusteredTable, curve

N = 40_000


@pytest.fixture(scope="module")
def messages(spark):
    """200 channels, of which one holds a third of the rows, over forty days."""
    k = F.xxhash64("id")
    channel = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("C"), F.pmod(k, F.lit(199)).cast("string")))
    seconds = (F.lit(1_700_000_000) + F.pmod(F.shiftright(k, 9), F.lit(40 * 86_400))).cast("string")
    return spark.range(N).select(channel.alias("channel_id"), F.concat(seconds, F.lit("."), F.lpad((F.col("id") % 1000).cast("string"), 6, "0")).alias("ts"), F.col("id").alias("n"))


@pytest.fixture(scope="module")
def table(spark, messages, tmp_path_factory):
    t = ClusteredTable(spark, str(tmp_path_factory.mktemp("clustered")), messages.schema, rows_per_file=500)
    assert t.append(messages.limit(0)) is None and t.read().count() == t.read("hot").count() == 0
    t.append(messages)
    return t


def numbers(df):
    return sorted(r["n"] for r in df.select("n").collect())


DAY = "1701000000", "1701086400.5"


@pytest.mark.parametrize("channel, bounds, share", [("C11", DAY, 0.05), ("C11", (None, None), 0.25), (None, DAY, 0.25), ("hot", DAY, 0.05), ("hot", (None, None), 0.6)])
def test_a_read_opens_few_files(table, messages, channel, bounds, share):
    since, until = bounds
    wanted = messages.where(F.col("channel_id") == channel) if channel else messages
    if since:
        wanted = wanted.where(F.col("ts").cast("decimal(28,9)").between(since, until))
    assert numbers(table.read(channel, since, until)) == numbers(wanted) != []
    everything = table.files().count()
    assert everything >= N // 500 * 0.7
    assert len(table.read(channel, since, until).inputFiles()) == table.files(channel, since, until).count() <= share * everything


def test_a_hot_channel_is_split(table):
    rows = [r[2] for r in table.zones().groupBy("layer", "file").agg(F.sum("rows")).collect()]
    assert sum(rows) == N and max(rows) < 3 * 500
    assert table.files("hot").count() > N / 3 / 500 / 2


def test_the_curve_alternates_bits(spark):
    got = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 0), (255, 255), (128, 0)], "a int, b int").select(curve(F.col("a"), F.col("b")).alias("p"))
    assert [r["p"] for r in got.collect()] == [0, 1, 2, 5, 65535, 16384]


def test_appends_compaction_and_what_died(spark, messages, tmp_path):
    t = ClusteredTable(spark, str(tmp_path / "t"), messages.schema, rows_per_file=2_000)
    odd = spark.createDataFrame([(None, "1701000001", -1), ("C11", "no time", -2), ("C11", None, -3), (None, None, -4), ("C11", "1701000001", -5), ("C11", "1701000001", -5)], messages.schema)
    for part in (messages.where("n % 2 = 0"), messages.where("n % 2 = 1"), odd):
        t.append(part)
    t._write(messages)  # died before it counted
    everything = numbers(messages.unionAll(odd))
    assert numbers(t.read()) == everything
    near = numbers(t.read("C11", "1701000000", "1701000002"))
    assert near.count(-5) == 2 and -2 not in near and {-2, -3} <= set(numbers(t.read("C11"))) and -1 in numbers(t.read(None, "1701000001", "1701000001"))
    before = t.files("C11", *DAY).count()
    t.compact()
    assert numbers(t.read()) == everything and numbers(t.read("C11", "1701000000", "1701000002")) == near
    assert t.files("C11", *DAY).count() <= before
    assert len(t.vacuum()) == 4


def test_of_two_compactions_the_second_fails(spark, messages, tmp_path, monkeypatch):
    t = ClusteredTable(spark, str(tmp_path / "t"), messages.schema, rows_per_file=50_000)
    for k in (0, 1):
        t.append(messages.where(f"n < 100 AND n % 2 = {k}"))
    seen = t._log()
    t.compact()
    monkeypatch.setattr(t, "_log", lambda: seen)
    with pytest.raises(FileExistsError):
        t.compact()
    monkeypatch.undo()
    assert numbers(t.read()) == list(range(100)) and t.compact() is None
