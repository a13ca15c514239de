import pytest

from lexweave.sinks.single import compose, read_head, replace_head, write_single


def uri(tmp_path, name, scheme):
    return f"{scheme}{tmp_path}/{name}"


@pytest.mark.parametrize("scheme", ["", "file://", "viewfs://here"])
def test_one_file_in_order(spark, tmp_path, scheme):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.here.link./tmp", "file:///tmp")
    target = uri(tmp_path, "list.txt", scheme)
    rows = spark.range(5000).selectExpr("format_string('%05d', (id * 7919) % 5000) AS k").selectExpr("k", "concat('- ', k, '\n  é') AS value").repartition(7)
    for _ in range(2):
        size = write_single(rows, ["k"], "head:\nfiles:\n", target)
    text = (tmp_path / "list.txt").read_bytes()
    assert text == ("head:\nfiles:\n" + "".join(f"- {k:05d}\n  é\n" for k in range(5000))).encode() and size == len(text)
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["list.txt"]
    head = read_head(spark, target, b"\nfiles:\n")
    assert head == b"head:\nfiles:\n"
    replace_head(spark, target, head, b"a longer head: 1\nfiles:\n")
    assert (tmp_path / "list.txt").read_bytes() == b"a longer head: 1\nfiles:\n" + text[len(head) :]


def test_csv_rows_and_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([("b", 'say "x", y'), ("a", None)], "k string, v string")
    write_single(rows, ["k"], "k,v\n", str(tmp_path / "t.csv"), "csv", escape='"')
    assert (tmp_path / "t.csv").read_text() == 'k,v\na,\nb,"say ""x"", y"\n'
    write_single(rows.where("k = 'z'"), ["k"], "k,v\n", str(tmp_path / "t.csv"), "csv")
    assert (tmp_path / "t.csv").read_text() == "k,v\n"


def test_heads(spark, tmp_path):
    assert read_head(spark, str(tmp_path / "none"), b"x") is None and read_head(spark, str(tmp_path), b"x") is None
    (tmp_path / "long").write_bytes(b"a" * 200000 + b"|rest")
    assert len(read_head(spark, str(tmp_path / "long"), b"|")) == 200001
    with pytest.raises(ValueError):
        read_head(spark, str(tmp_path / "long"), b"?")
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "old").write_text("x")
    compose(spark, b"head ", [str(tmp_path / "long")], str(tmp_path / "folder"), skip=200001)
    assert (tmp_path / "folder").read_bytes() == b"head rest"
