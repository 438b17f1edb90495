"""Splittable CSV: equal to the one-task multi-line reader wherever the file is cut."""

import csv
import io

import pyarrow as pa
import pytest

from tabmine.sources.csv_records import REST, WHOLE, _Cutter, csv_records, read_csv
from tabmine.sources.io import write_table

TEXT = ('id,"a ""b"",\nc",d\r\n1,"x\ny","say ""hi"""\r\n2,,""\r\n3,plain,"\n\n"\r\n'
        '4,"é,\r\n""","z"\r\n5,"' + 'q\n' * 12 + '",end\r\n')


@pytest.fixture
def cut_at(spark):
    """Sets the block size, and puts the settings back."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    old = {k: spark.conf.get(k, None) for k in keys}

    def set_to(n):
        for k, v in zip(keys, (n, 1, 1)):
            spark.conf.set(k, str(v))
    yield set_to
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def one_task(spark, path):
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("lineSep", "\r\n")
            .csv(path))


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equal_to_one_task_at_every_cut(spark, tmp_path, cut_at):
    p = str(tmp_path / "f.csv")
    raw = TEXT.encode()
    open(p, "wb").write(raw)
    whole = one_task(spark, p)
    want, names = values(whole), whole.columns
    assert len(want) == 5 and names[1] == 'a "b",\nc'
    for size in (len(raw), len(raw) // 2, 37, 11):
        cut_at(size)
        got = read_csv(spark, p)
        assert got.columns == names
        assert values(got) == want, size
    cut_at(8)
    assert spark.read.text(p).rdd.getNumPartitions() > 12
    assert values(read_csv(spark, p, broadcast_bytes=0)) == want  # blocks beyond a broadcast


@pytest.mark.parametrize("step", range(1, 130))
def test_cutter_at_every_offset(step):
    """Blocks of ``step`` bytes, dealt lines as a line reader does: a line is of the block that holds its first byte's predecessor."""
    lines, at, blocks = TEXT.split("\n")[:-1], 0, {}
    for line in lines:
        blocks.setdefault(max(0, -(-at // step) - 1) * step if at else 0, []).append(line)
        at += len(line.encode()) + 1
    inside, whole, pieces, cutter = False, [], [], _Cutter()
    for k, (block, own) in enumerate(sorted(blocks.items())):
        whole += cutter.lines(k, inside, block, pa.array(own)).to_pylist()
        inside ^= sum(x.count('"') for x in own) % 2 == 1
    cutter.end()
    b, kind, top, record = (c.to_pylist() for c in cutter.taken().columns)
    rest = ""
    for x in sorted(zip(b, [{WHOLE: 3}.get(k, k) for k in kind], record)):
        if x[1] == 3:
            whole.append(x[2])
        elif x[1] == REST:
            rest += "\n" + x[2]
        else:
            pieces, rest = pieces + [rest], x[2]
    whole += [p for p in (*pieces, rest) if p]
    assert sum(top) == 1 and not inside
    parsed = list(csv.reader(io.StringIO(TEXT, newline="")))
    assert sorted(next(csv.reader(io.StringIO(r, newline=""))) for r in whole) == sorted(parsed)


def test_every_header_is_checked(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("x,y\n1,one\n2,two\n")
    b.write_text("y,x\nthree,3")          # another order, no line break at the end
    assert values(read_csv(spark, str(tmp_path))) == [("1", "one"), ("2", "two"), ("3", "three")]
    b.write_text("x,z\n3,three\n")
    with pytest.raises(ValueError, match="b.csv"):
        read_csv(spark, str(tmp_path))
    b.write_text('x,y\n3,"three\n')
    with pytest.raises(ValueError, match="b.csv ends inside quotes"):
        read_csv(spark, str(tmp_path))
    b.write_text("")
    assert read_csv(spark, str(tmp_path)).count() == 2


def test_wrong_number_of_values_fails(spark, tmp_path):
    p = tmp_path / "f.csv"
    p.write_text("x,y\n1,2\n3\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_csv(spark, str(p)).collect()
    p.write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, str(p))


def test_written_tables_come_back(spark, tmp_path, cut_at):
    import random
    rng = random.Random(1)
    rows = [(i, None if i % 7 == 0 else "".join(rng.choice('ab ",\n\r\\é\t') for _ in range(rng.randrange(12))) + "|",
             rng.choice([None, "", "x", '"', " y "])) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, text string, other string")
    p = write_table(df.repartition(3), str(tmp_path / "t"), "csv")
    for size in (400, 1 << 20):
        cut_at(size)
        assert values(read_csv(spark, p)) == sorted(((str(a), b, c or None) for a, b, c in rows), key=repr)
    assert csv_records(spark, p).filter("top").count() == 3
