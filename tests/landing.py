"""Small landed files of every kind, as the exchanges would serve them."""

from __future__ import annotations

import io
import json
import os
import zipfile

FUTURES_HEADER = "date,contract,expire,time,price,volume,near,far,auction"
DAY = "2022_01_20"


def put(path: str, content: bytes) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(content)


def zipped(**members: str) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name + ".csv", text.encode("utf-8"))
    return buffer.getvalue()


def crlf(*lines: str) -> str:
    return "\r\n".join(lines) + "\r\n"


def land_futures(root: str, day: str = DAY) -> None:
    date = day.replace("_", "")
    outright = crlf(
        FUTURES_HEADER,
        f"{date},TX     ,202202     ,084500,18210,3,-,-,*",
        f"{date},TX     ,202202     ,084500,18212,1,-,-, ",
        f"{date},TX     ,202202     ,084501,18208.5,2,-,-, ",
        f"{date},ZZZ    ,202202     ,084500,100,2,-,-, ",
        f"{date},MTX    ,202201W4   ,084659,18209,5,-,-, ",
        f"{date},MTX    ,209912     ,084659,18209,5,-,-, ",
        f"{date},MTX    ,202202     ,084659,-,5,-,-, ",
    )
    spreads = crlf(
        FUTURES_HEADER,
        f"{date},TX     ,202202/202203     ,090001,-20,4,18200,18180, ",
        f"{date},MTX    ,202201W4/202202   ,090001,-5,3,18201,18196, ",
        f"{date},TX     ,202202/202203     ,090002,-20,2,18200,-, ",
    )
    put(f"{root}/raw/futures/Daily_{day}.zip", zipped(trades=outright))
    put(f"{root}/raw/futures/Daily_{day}_C.zip", zipped(trades=spreads))


def land_options(root: str, day: str = DAY) -> None:
    date = day.replace("_", "")
    lines = crlf(
        "title",
        "date,contract,strike,expire,type,time,price,volume,auction",
        f"{date},TXO ,17800     ,202202     ,C ,084500,120.5,1,",
        f"{date},TXO ,17800     ,202202     ,C ,084530,121,2,",
        f"{date},TXO ,17800     ,202202     ,P ,084530,80,4,",
        f"{date},TXO ,17900     ,202201W4   ,C ,084530,60,1,",
        f"{date},CDO ,17900     ,202202     ,C ,084530,60,1,",
    )
    put(f"{root}/raw/options/OptionsDaily_{day}.zip", zipped(trades=lines))


def land_index(root: str, day: str = DAY) -> None:
    lines = crlf(
        '"title"',
        '"time","TAIEX","other"',
        '"=""09:00:00""","18,210.35","1"',
        '="09:00:05","18,211.00","1"',
        '="09:04:59","18,200.10","1"',
        '"note: values may change"',
    )
    put(f"{root}/raw/index/index_{day}.csv", lines.encode("utf-8"))


def land_etf(root: str, day: str = DAY) -> None:
    iso = day.replace("_", "-")
    ticks = [("09:00:03.123", 101.25, 4), ("09:00:03.900", 101.5, 1), ("09:20:00.000", 101.0, 2)]
    document = {
        "data": [
            {"date": iso, "Time": t, "stock_id": "006204", "deal_price": p, "volume": v}
            for t, p, v in ticks
        ]
    }
    put(f"{root}/raw/etf/etf_{day}.json", json.dumps(document).encode("utf-8"))


def land_holidays(root: str, roc_year: int = 111) -> None:
    text = "\r\n".join(
        [
            '"111 holidays"',
            '"名稱","日期","星期","說明","備註"',
            '"春節","2月1日","二","休市, 放假","  "',
            '"補行交易","1月22日","六","補行交易","o"',
            '"元旦","1月1日","六","依規定放假",""',
            "",
        ]
    )
    put(f"{root}/raw/holidays/holidaySchedule_{roc_year}.csv", text.encode("big5"))


def land_day(root: str, day: str = DAY) -> None:
    land_futures(root, day)
    land_options(root, day)
    land_index(root, day)
    land_etf(root, day)
