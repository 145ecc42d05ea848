"""A table with a units line that is written as many files loses no rows, wherever the header's file is read."""

from obskit.sources import tables


def test_header_in_a_file_of_its_own(spark, tmp_path):
    path = tmp_path / "table"
    path.mkdir()
    (path / "part-b.txt").write_text("# made\nStation\tAs\n\tug/L\nfirst\t0\n")
    for k in range(3):
        (path / f"part-{'acd'[k]}.txt").write_text("".join(f"station-{k}-{i}\t{i}\n" for i in range(200)))
    df, units = tables.read_units_header_table(spark, str(path), "Station\t")
    want = [("first", "0")] + [(f"station-{k}-{i}", str(i)) for k in range(3) for i in range(200)]
    assert units["As"] == "ug/L" and sorted(tuple(r) for r in df.collect()) == sorted(want)
