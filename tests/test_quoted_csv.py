"""Quoted CSV in byte ranges: cuts anywhere give the records of one forward parse."""

import csv
import gzip
import io
import os
import random

import pytest

from shopmetrics.sources import ingest, quoted_csv


def rows_of(spark, path, range_bytes):
    got = quoted_csv.read_records(spark, path, range_bytes).collect()
    return [r["value"] for r in sorted(got, key=lambda r: (r["file"], r["row"]))]


def random_csv(seed, n):
    """Records whose fields hold quotes, commas, line breaks and letters of several bytes."""
    rng = random.Random(seed)
    bits = ["a", "é", "日本", ",", "\n", '"', "\r\n", " ", "x" * 40]
    rows = [["".join(rng.choices(bits, k=rng.randint(0, 8))) for _ in range(3)] for _ in range(n)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL).writerows([["a", "b", "c"], *rows])
    return out.getvalue(), rows


def parsed(texts):
    return [next(csv.reader(io.StringIO(t, newline=""))) for t in texts]


@pytest.mark.parametrize("range_bytes", [1 << 20, 997, 64, 7])
def test_ranges_of_any_size_give_the_same_records(spark, tmp_dir, range_bytes):
    text, rows = random_csv(range_bytes, 60 if range_bytes < 64 else 300)
    path = os.path.join(tmp_dir, "t.csv")
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    assert parsed(rows_of(spark, path, range_bytes)) == rows


def test_states_match_a_forward_scan():
    """The pair of states of every cut composes to the state of the whole prefix."""
    text, _ = random_csv(5, 200)
    lines = text.encode().split(b"\n")
    state, prefix = 0, []
    for line in lines:
        prefix.append(state)
        state = quoted_csv._inside_after(line, state)
    assert set(prefix) == {0, 1}
    for cut in range(0, len(lines), 17):
        ends = [0, 1]
        for line in lines[cut:]:
            ends = [quoted_csv._inside_after(line, s) for s in ends]
        assert ends[prefix[cut]] == state


def test_stray_quotes_follow_the_reader(spark, tmp_dir):
    """A quote inside an unquoted field opens nothing; text after a closing quote runs to the comma."""
    path = os.path.join(tmp_dir, "stray.csv")
    with open(path, "w", newline="") as f:
        f.write('a,b\n5" disk,1\n"x"y,2\n"",3\n"""q""",4\n')
    spark_rows = [tuple(r) for r in spark.read.option("header", True).option("multiLine", True)
                  .option("escape", '"').csv(path).collect()]
    df = ingest.read_raw_csv(spark, path)
    ours = [tuple(r)[:2] for r in sorted(df.collect(), key=lambda r: r[ingest.INGEST_SEQ]["row"])]
    assert ours == spark_rows and len(ours) == 4


def test_defined_cases(spark, tmp_dir):
    def put(name, data, opener=open):
        with opener(os.path.join(tmp_dir, name), "wb") as f:
            f.write(data)
        return os.path.join(tmp_dir, name)

    assert rows_of(spark, put("empty.csv", b""), 8) == []
    assert rows_of(spark, put("head.csv", b"a,b\n"), 8) == []
    assert rows_of(spark, put("blank.csv", b"\n\na,b\r\n\r\n1,2\r\n\n3,4"), 4) == ["1,2", "3,4"]
    assert rows_of(spark, put("open.csv", b'a,b\n1,"x\n2,y\n'), 5) == ['1,"x\n2,y']
    assert rows_of(spark, put("bytes.csv", b"a\n\xff\n"), 2) == ["�"]
    assert rows_of(spark, put("z.csv.gz", b'a,b\n1,"x\ny"\n2,z\n', gzip.open), 4) == ['1,"x\ny"', "2,z"]
    long = b'a,b\n1,"' + b"line\n" * 3000 + b'"\n2,z\n'
    assert [len(v) for v in rows_of(spark, put("long.csv", long), 900)] == [15004, 3]


def test_one_big_file_plans_many_tasks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "big.csv")
    with open(path, "w") as f:
        f.write("a,b\n" + "".join(f'{i},"v\n{i}"\n' for i in range(5000)))
    assert quoted_csv.byte_ranges(spark, path, 4096).count() > 15
    records = quoted_csv.read_records(spark, path, 4096)
    assert records.rdd.getNumPartitions() > 15
    assert records.count() == 5000


def test_byte_sizes():
    assert [quoted_csv._byte_size(t) for t in ("134217728b", "128m", "1GB", "64", "2kb")] == [
        1 << 27, 1 << 27, 1 << 30, 64, 2048]
