"""Archives as a data source: tasks, numbers, plans and errors."""

from __future__ import annotations

import datetime as dt
import io
import zipfile

import pytest
from landing import DAY, FUTURES_HEADER, crlf, land_day, put, zipped

from barweave.sources import archives, landed
from barweave.sources.archives import Piece, member_lines, numbered, packed


def lines_of(frame):
    return [(r.file_no, r.member, r.line_no, r.line) for r in frame.orderBy("file_no", "line_no").collect()]


def test_a_member_is_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "BATCH_LINES", 3)
    put(f"{tmp_path}/Daily_{DAY}.zip", zipped(one=crlf(*(f"a{i}" for i in range(7))), two=crlf("b0", "b1")))
    found = member_lines(spark, str(tmp_path), zipped=True)
    assert found.rdd.getNumPartitions() == 2
    first = [(1, "one.csv", i, f"a{i}") for i in range(7)]
    assert lines_of(found) == [*first, (2, "two.csv", 0, "b0"), (2, "two.csv", 1, "b1")]
    assert {r.ds for r in found.collect()} == {dt.date(2022, 1, 20)}


def test_no_exchange_before_parsing(spark, tmp_path):
    land_day(str(tmp_path))
    for reader, kind in ((landed.read_futures, "futures"), (landed.read_options, "options"), (landed.read_index, "index")):
        frame = reader(spark, f"{tmp_path}/raw/{kind}", [DAY])
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and "BatchScan" in plan


def test_as_by_whole_files(spark, tmp_path, monkeypatch):
    """Stores without members give the same records, by the other reader."""
    land_day(str(tmp_path))
    land_day(str(tmp_path), "2022_01_21")
    folder = f"{tmp_path}/raw/futures"
    by_member = sorted(map(tuple, landed.read_futures(spark, folder).collect()), key=str)
    monkeypatch.setattr(landed, "has_members", lambda path: False)
    by_file = sorted(map(tuple, landed.read_futures(spark, folder).collect()), key=str)
    assert by_member == by_file and len(by_member) == 20


def test_days_are_chosen_by_name(spark, tmp_path):
    for day in ("2022_01_20", "2022_01_21", "2022_01_24"):
        put(f"{tmp_path}/index_{day}.csv", crlf(day).encode())
    put(f"{tmp_path}/_index_2022_01_20.csv", crlf("hidden").encode())
    put(f"{tmp_path}/notes.csv", crlf("no day").encode())
    some = member_lines(spark, str(tmp_path), ["2022_01_20", "2022_01_24"])
    assert sorted(r.line for r in some.collect()) == ["2022_01_20", "2022_01_24"]
    every = {r.line: r.ds for r in member_lines(spark, str(tmp_path)).collect()}
    assert every["no day"] is None and len(every) == 4


def test_nothing_there(spark, tmp_path):
    put(f"{tmp_path}/some/x.zip", zipped())
    assert member_lines(spark, f"{tmp_path}/some", zipped=True).count() == 0
    assert member_lines(spark, f"{tmp_path}/some", ["2022_01_20"], zipped=True).count() == 0
    with pytest.raises(Exception, match="absent"):
        member_lines(spark, f"{tmp_path}/absent", zipped=True).count()


@pytest.mark.parametrize("damage", ["cut", "flipped"])
def test_damage_is_an_error(spark, tmp_path, damage):
    lines = crlf(FUTURES_HEADER, *(f"20220120,TX,202202,084500,{n},3,-,-,*" for n in range(3000)))
    content = bytearray(zipped(trades=lines))
    if damage == "cut":
        content = content[: len(content) // 2]
    else:
        content[len(content) // 2] ^= 0xFF
    put(f"{tmp_path}/Daily_{DAY}.zip", bytes(content))
    with pytest.raises(Exception, match=f"archive .*Daily_{DAY}"):
        member_lines(spark, str(tmp_path), zipped=True).count()


def test_folders_in_archives_and_odd_bytes(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("in/", b"")
        archive.writestr("in/a b.csv", "中文".encode("big5") + b"\r\n\xff bad\r\nlast")
    put(f"{tmp_path}/with space {DAY}.zip", buffer.getvalue())
    found = lines_of(member_lines(spark, str(tmp_path), charset="big5", zipped=True))
    assert [f[0] for f in found] == [1, 1, 1]
    assert found[0][3] == "中文" and found[1][3].endswith(" bad") and found[2][3] == "last"


def test_numbers_and_packing():
    names = ["P_2022_01_20_C.zip", "B_2022_01_20.zip", "A_2022_01_20.zip", "A_2022_01_21.zip"]
    pieces = [Piece(f"file:/x/{n}", "m", at, 1) for n in names for at in (1, 0)]
    order = [(p.uri.rsplit("/", 1)[1], p.at, p.file_no) for p in numbered(pieces)]
    day = [o for o in order if "01_20" in o[0]]
    assert [n for *_, n in day] == [1, 2, 3, 4, 5, 6] and [o[0][0] for o in day] == list("AABBPP")
    assert [o[1] for o in day] == [0, 1] * 3
    assert [o[2] for o in order if "01_21" in o[0]] == [1, 2]
    plain = [Piece(f"file:/x/{n}", "m", None, 5 << 20) for n in range(12)]
    shares = [len(p.pieces) for p in packed(plain)]
    assert sum(shares) == 12 and max(shares) == 5
    assert [len(p.pieces) for p in packed([Piece("file:/x/y", "m", None, 1 << 40)] * 2)] == [1, 1]
    assert packed([]) == []
