import random

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import files
from tallyloom.sources.sheet_parts import sheet_lines

COLUMNS = ["a", "b", "c"]


@pytest.fixture
def parts_of(spark):
    """Sets the bytes a task reads of a file."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def set_bytes(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_bytes
    for name, value in old.items():
        spark.conf.set(name, value)


def random_sheet(seed, end):
    draw = random.Random(seed)
    cells = ["x", "", "7", '"one, two"', '"line\nbreak"', '"a\r\nb"', '"say ""hi"""', '"\n\n"', "é漢", '""', "long" * draw.randint(1, 30)]
    rows = [",".join(draw.choice(cells) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(1, 120))]
    text = end.join(rows) + draw.choice(["", end, end + end])
    return text + draw.choice(["", "", '5" pipe\nlast,1\n', 'x\ry,"2\n3"\rz\n'])


@pytest.mark.parametrize("size", [40, 300, 1 << 20])
def test_parts_give_the_rows_of_the_whole(spark, tmp_path, parts_of, size):
    for seed in range(12):
        (tmp_path / f"s{seed}.csv").write_bytes(random_sheet(seed, ("\n", "\r\n")[seed % 2]).encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    parts_of(size)
    for first_row, first_column in ((1, 1), (5, 2)):
        one, many = (files.read_block(spark, str(tmp_path), COLUMNS, first_row, first_column, p) for p in (False, True))
        assert one.columns == many.columns
        found, wanted = (sorted(map(tuple, df.collect()), key=repr) for df in (many, one))
        assert found == wanted and len(wanted) > 100


def test_a_file_is_read_by_several_tasks(spark, tmp_path, parts_of):
    body = "".join(f'{i},"line {i}\nand ""more""\r\n",{"x" * (i % 50)}\n' for i in range(2000))
    (tmp_path / "s.csv").write_text(body, newline="")
    parts_of(4096)
    lines = sheet_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 10
    assert lines.select("block").distinct().count() > 10
    block = files.read_block(spark, str(tmp_path), COLUMNS, in_parts=True)
    assert block.where(F.col("b") == F.concat(F.lit("line "), "a", F.lit('\nand "more"\r\n'))).count() == 2000
    assert [r.row for r in block.orderBy("row").select("row").collect()] == list(range(1, 2001))


def test_a_cell_over_many_blocks(spark, tmp_path, parts_of):
    text = "word\n" * 500
    (tmp_path / "s.csv").write_text(f'1,"{text}",x\n2,b,y\n3,"{text}{text}",z\n')
    parts_of(100)
    block = files.read_block(spark, str(tmp_path), COLUMNS, in_parts=True)
    assert [tuple(r)[1:] for r in block.orderBy("row").collect()] == [(1, "1", text, "x"), (2, "2", "b", "y"), (3, "3", text + text, "z")]
