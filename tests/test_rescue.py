"""Pages and records that can't be read: set aside, repaired, replayed once."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.plans import ingest
from tidewell.sources import read_pages, rescue_pages

D1, D2, D3, D4 = (date(2024, 1, n) for n in range(1, 5))
CUT = '{"records":[{"Id":"3","Name":"cut","LastModifiedDate":"2024-01-02"}'


def record(key, name, modified="2024-01-02"):
    return f'{{"Id":"{key}","Name":"{name}","LastModifiedDate":"{modified}"}}'


def page(*records):
    return '{"records":[' + ",".join(records) + "]}"


@pytest.fixture
def lake(spark, tmp_path):
    return ingest.Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def put(tmp_path):
    def write(folder, *lines):
        target = tmp_path / folder
        target.mkdir()
        (target / "a.json").write_text("\n".join(lines) + "\n")
        return str(target)

    return write


def names(lake):
    return dict(rows(lake.bronze("sales", "Account").select("Id", "Name")))


def aside(lake, **options):
    found = ingest.quarantined(lake, "sales", "Account", **options)
    return rows(found.select("place", "reason", "text", "load"), "load", "place", "text")


def mend(text):
    return F.when(text.startswith('{"records"'), F.concat(text, F.lit("]}"))).when(text == "7", F.lit(record("7", "seven")))


def test_sound_pages_read_as_ever(spark, put):
    source = put("p", page(record("1", "a"), record("2", "b")), '{"records":[]}', '{"done":true}', "", page('{"Id":3,"Name":{"x":[1]}}'))
    strict, loose = read_pages(spark, source, "sales", "Account"), rescue_pages(spark, source, "sales", "Account")
    assert loose.where("_rejected IS NOT NULL").count() == 0
    assert loose.drop("_rejected").columns == strict.columns
    text = F.to_json(F.struct("*")).alias("r")
    assert rows(loose.drop("_rejected").select(text), "r") == rows(strict.select(text), "r")


def test_reasons_and_places(spark, put):
    source = put("p", page(record("1", "a"), "7", "null", '"x"', record("2", "b")), CUT, '{"records":{"Id":"1"}}', "[1]", "3")
    found = rescue_pages(spark, source, "sales", "Account")
    assert rows(found.where("_rejected IS NULL").select("Id"), "Id") == [("1",), ("2",)]
    why = rows(found.where("_rejected IS NOT NULL").select("_rejected.place", "_rejected.reason", "_rejected.text"))
    assert sorted(why) == sorted([
        (1, "not a record", "7"), (2, "not a record", "null"), (3, "not a record", '"x"'), (-1, "not JSON", CUT),
        (-1, "no list of records", '{"records":{"Id":"1"}}'), (-1, "no list of records", "[1]"), (-1, "no list of records", "3"),
    ])
    assert found.where("_rejected.file LIKE '%a.json'").count() == 7


def test_bad_pages_fail_unless_rescued(lake, put):
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ_FILE"):
        ingest.ingest_entity(lake, "sales", "Account", put("p", CUT), D1)


def test_replayed_once(lake, put):
    source = put("p", page(record("1", "a"), "7"), CUT, "lost")
    done = ingest.ingest_entity(lake, "sales", "Account", source, D1, rescue=True)
    assert (done["records"], done["rejected"]) == (1, 3)
    assert names(lake) == {"1": "a"}
    assert [r[:2] for r in aside(lake)] == [(-1, "not JSON"), (-1, "not JSON"), (1, "not a record")]
    assert ingest.replay(lake, "sales", "Account", mend, D2)["records"] == 2
    assert names(lake) == {"1": "a", "3": "cut", "7": "seven"}
    assert aside(lake) == [] and len(aside(lake, all_loads=True)) == 3
    assert ingest.replay(lake, "sales", "Account", mend, D2)["records"] == 0
    # the state of the extract is as it was
    state = lake.state.load("sales", "Account")
    assert (state["load_date"], state["last_modified"], state["loads"]) == ("2024-01-01", "2024-01-02", 3)


def test_a_replay_changes_nothing_newer(lake, put):
    old = '{"records":[' + record("1", "old", "2024-01-01") + "," + record("2", "new", "2024-01-09") + "," + '{"Id":"4","Name":"undated"}'
    ingest.ingest_entity(lake, "sales", "Account", put("p", old, page(record("4", "four"))), D1, rescue=True)
    ingest.ingest_entity(lake, "sales", "Account", put("q", page(record("1", "one", "2024-01-05"), record("2", "two", "2024-01-05"))), D2)
    assert ingest.replay(lake, "sales", "Account", mend, D3)["records"] == 1
    assert names(lake) == {"1": "one", "2": "new", "4": "four"}
    # the next extract starts from the mark of the extracts, not from that of the replay
    ingest.ingest_entity(lake, "sales", "Account", put("r", page(record("5", "five", "2024-01-06"))), D4)
    assert names(lake)["5"] == "five"


def test_what_stays_broken_is_set_aside_again(lake, put):
    ingest.ingest_entity(lake, "sales", "Account", put("p", CUT, page("7")), D1, rescue=True)
    done = ingest.replay(lake, "sales", "Account", lambda text: text, D2)
    assert (done["records"], done["rejected"]) == (0, 2)
    assert [r[3] for r in aside(lake)] == [1, 1]
    assert ingest.replay(lake, "sales", "Account", mend, D3)["records"] == 2
    assert aside(lake) == []


def test_a_replay_that_died_is_repeated(lake, put, monkeypatch):
    ingest.ingest_entity(lake, "sales", "Account", put("p", CUT), D1, rescue=True)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(lake.state, "save", die)
        with pytest.raises(RuntimeError):
            ingest.replay(lake, "sales", "Account", mend, D2)
    assert names(lake) == {} and len(aside(lake)) == 1
    ingest.replay(lake, "sales", "Account", mend, D2)
    assert names(lake) == {"3": "cut"} and aside(lake) == []
    assert len(list(Path(lake.dataset(lake.spec("sales", "Account"))).glob("load=*"))) == 2


def test_nothing_rejected(lake, put):
    assert aside(lake) == []
    done = ingest.ingest_entity(lake, "sales", "Account", put("p", page(record("1", "a"))), D1, rescue=True)
    assert done["rejected"] == 0 and aside(lake) == []
