"""Files whose records span lines, read in many splits: the rows of the one-task reader."""

import csv
import io
import json
import random

import pytest

from tillroll.schemas import SPECS
from tillroll.sources.files import CORRUPT, FeedLoadError, load_csv, load_json
from tillroll.sources.fixtures import SEQ
from tillroll.sources.spliced import ListElements, QuotedLines, block_states, pieces, splice


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "4096")
    spark.conf.set(names[1], "1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _random_csv(rng, n, line_end="\n"):
    """Rows with quoted commas, quotes and line ends, and bare fields with a quote inside."""
    rows = []
    for i in range(n):
        note = "".join(rng.choices(["a", "b ", ",", "\n", '"', "x\ny\n", "é"], k=rng.randint(0, 12)))
        rows.append([str(i), note, rng.choice(["plain", "", "6 inch", "two words"])])
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["id", "note", "kind"])
    writer.writerows(rows)
    return out.getvalue()


def _one_task(spark, path):
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return [(r.id, r.note, r.kind) for r in df.collect()]


@pytest.mark.parametrize("seed", range(3))
def test_random_quoting_gives_the_rows_of_the_one_task_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    folder = tmp_path / "feed"
    folder.mkdir()
    for i in range(2):
        (folder / f"f{i}.csv").write_text(_random_csv(rng, 1500), newline="")
    df = load_csv(spark, str(folder))
    parts = pieces(spark, str(folder), "\n")
    assert parts.rdd.getNumPartitions() > 8
    got = df.where(f"{CORRUPT} is null").collect()
    clean = lambda x: x if x not in ("", None) else None
    want = [(a, clean(b), clean(c)) for a, b, c in _one_task(spark, str(folder))]
    assert sorted(map(str, ((r.id, r.note, r.kind) for r in got))) == sorted(map(str, want))
    # the place in the feed orders rows as they stand in their file
    by_file: dict = {}
    for r in got:
        by_file.setdefault(r[SEQ].file, []).append(((r[SEQ].block, r[SEQ].pos), int(r.id)))
    assert all([i for _, i in sorted(v)] == sorted(i for _, i in v) for v in by_file.values())


def test_one_field_over_many_splits(spark, tmp_path, small_splits):
    p = tmp_path / "long.csv"
    long = "\n".join(f'line {i}, with ""quotes""' for i in range(3000))
    p.write_text(f'id,note\n1,"{long}"\n2,end\n3,"a\nb"\n')
    rows = {r.id: r.note for r in load_csv(spark, str(p)).collect()}
    assert rows["1"] == long.replace('""', '"') and rows["2"] == "end" and rows["3"] == "a\nb" and len(rows) == 3


def test_a_stray_quote_in_a_bare_field_opens_nothing(spark, tmp_path, small_splits):
    p = tmp_path / "inch.csv"
    p.write_text("id,note\n" + "\n".join(f'{i},{i} 5" pipe' if i == 700 else f"{i},pipe" for i in range(2000)) + "\n")
    df = load_csv(spark, str(p))
    assert df.count() == 2000 and {r.note for r in df.where("id = 700").collect()} == {'700 5" pipe'}
    assert pieces(spark, str(p), "\n").rdd.getNumPartitions() > 4


def test_an_open_quote_at_the_end_and_windows_line_ends(spark, tmp_path):
    p = tmp_path / "open.csv"
    p.write_text('id,note\r\n1,"a\r\nb"\r\n2,c\r\n3,"never closed\r\nmore\r\n', newline="")
    rows = {r.id: (r.note, r[CORRUPT]) for r in load_csv(spark, str(p)).collect()}
    assert rows["1"] == ("a\r\nb", None) and rows["2"] == ("c", None)
    assert len(rows) == 3


def test_headers_must_agree(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_text('id,note\n1,"x\ny"\n')
    (folder / "b.csv").write_text('note,id\nz,2\n')
    with pytest.raises(FeedLoadError):
        load_csv(spark, str(folder))


def test_state_functions_compose():
    rng = random.Random(1)
    lines = _random_csv(rng, 400).split("\n")
    for machine, all_ in ((QuotedLines, lines), (ListElements, _json_text(rng, 300).split("}"))):
        state, want = machine.first, []
        cuts = sorted(rng.sample(range(1, len(all_)), 9))
        blocks = [all_[a:b] for a, b in zip([0, *cuts], [*cuts, len(all_)])]
        ends = {}
        for i, block in enumerate(blocks):
            want.append(state)
            for v in block:
                state = machine.after(state, v)
            ends[("f", i)] = {s: _run(machine, s, block) for s in machine.starts}
        assert list(block_states(ends, machine).values()) == want


def _run(machine, state, block):
    for v in block:
        state = machine.after(state, v)
    return state


def _json_text(rng, n, indent=None):
    def value(depth):
        kind = rng.randint(0, 5 if depth < 3 else 2)
        if kind == 0:
            return "".join(rng.choices(["a", '"', "\\", "{", "}", "[", "]", ",", "\n", "é"], k=rng.randint(0, 8)))
        if kind == 1:
            return rng.randint(-5, 10**6)
        if kind == 2:
            return rng.choice([True, None, 2.5])
        return {f"k{i}": value(depth + 1) for i in range(rng.randint(0, 3))} if kind < 5 else [value(depth + 1) for _ in range(rng.randint(0, 3))]

    return json.dumps([{"payment_id": i, "payment_method": value(3), "extra": value(0)} for i in range(n)], indent=indent)


@pytest.mark.parametrize("indent", [None, 2])
def test_a_json_list_is_read_in_many_tasks(spark, tmp_path, small_splits, indent):
    text = _json_text(random.Random(7), 900, indent)
    p = tmp_path / "payments.json"
    p.write_text(text)
    schema = SPECS["payments"].feed_struct()
    df = load_json(spark, str(p), schema=schema)
    assert pieces(spark, str(p), "}").rdd.getNumPartitions() > 8
    want = sorted(str((r.payment_id, r.payment_method)) for r in spark.read.option("multiLine", True).schema(schema).json(str(p)).collect())
    got = df.collect()
    assert sorted(str((r.payment_id, r.payment_method)) for r in got) == want and len(got) == 900
    assert all(r[CORRUPT] is None for r in got)


def test_elements_that_are_no_records_are_kept_apart(spark, tmp_path):
    p = tmp_path / "payments.json"
    p.write_text('[ {"payment_id": 1}, 5, {"payment_id": 2}, {"payment_id": }, {"payment_id": 3} ]')
    got = load_json(spark, str(p), schema=SPECS["payments"].feed_struct()).collect()
    assert sorted(r.payment_id for r in got if r[CORRUPT] is None) == ["1", "3"]
    assert sorted(r[CORRUPT] for r in got if r[CORRUPT]) == ['5, {"payment_id": 2}', '{"payment_id": }']


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": "x]', '[{"a": 1}]]'])
def test_a_broken_list_is_an_error(spark, tmp_path, text):
    p = tmp_path / "x.json"
    p.write_text(text)
    with pytest.raises(FeedLoadError):
        load_json(spark, str(p), schema=SPECS["payments"].feed_struct()).collect()


def test_an_empty_list(spark, tmp_path):
    p = tmp_path / "x.json"
    p.write_text(" [ ]\n")
    assert load_json(spark, str(p), schema=SPECS["payments"].feed_struct()).count() == 0


def test_a_stream_reads_quoted_line_ends(spark, tmp_path):
    import datetime as dt

    from tillroll.sources.tables import TableStore
    from tillroll.streaming import ingest_stream

    feed = tmp_path / "stores"
    feed.mkdir()
    (feed / "a.csv").write_text('store_id,store_name,city,state,country\n1,"North\nPier","a, b",NA,x\n2,South,,,\n3,"bad"x,,,\n')
    store = TableStore(spark, str(tmp_path / "wh"))
    ingest_stream(spark, store, "stores", str(feed), str(tmp_path / "ckpt"), run_ts=dt.datetime(2024, 1, 1))
    rows = {r.store_id: (r.store_name, r.city) for r in store.read("raw", "stores").collect()}
    assert rows[1] == ("North\nPier", "a, b") and rows[2] == ("South", None)


def test_splice_of_nothing(spark):
    empty = spark.createDataFrame([], "file string, block long, value string")
    assert splice(empty, QuotedLines).count() == 0
