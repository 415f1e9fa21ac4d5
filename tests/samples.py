"""Invented sample tables, as CSV text, whose outcome is known row by row."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.plans import goods
from siltgate.sources.readers import read_csv

CUSTOMERS = """customer_id,name,email,country,signup_date,raw_source
K1,Anna Test,anna@shop.test,FI,2020-05-01,app
K2,Bert Test,bert@shop.test,,2020-05-02,app
K3,  ,carl@shop.test,FI,2020-05-03,app
K4,Dora Test,dora.shop.test,FI,2020-05-04,desk
K1,Anna Again,again@shop.test,SE,2020-05-05,desk
K5,Emil Test,,FI,2020-05-06,desk
K6,Faye Test,faye@shop.test,NO
"""

ORDERS = """order_id,customer_id,order_date,amount,currency,status,ingested_at
P1,K1,2020-06-01,10.5,EUR,paid,2020-06-01 10:00:00
P2,K2,2020-06-01,0,EUR,paid,2020-06-01 10:00:00
P3,K6,2020-06-02,7,EUR,lost,2020-06-02 10:00:00
P4,,2020-06-02,7,EUR,pending,2020-06-02 10:00:00
P5,K3,2020-06-03,8,EUR,shipped,2020-06-03 10:00:00
P1,K2,2020-06-04,11,EUR,refunded,2020-06-04 10:00:00
P6,K6,2020-06-05,12.25,EUR,cancelled,2020-06-05 10:00:00
P7,K2,2020-06-05,,EUR,paid,2020-06-05 10:00:00
"""

CUSTOMER_SCHEMA = (
    "customer_id STRING, name STRING, email STRING, country STRING, signup_date DATE, "
    "raw_source STRING"
)
ORDER_SCHEMA = (
    "order_id STRING, customer_id STRING, order_date DATE, amount DOUBLE, currency STRING, "
    "status STRING, ingested_at TIMESTAMP"
)
MOVEMENT_SCHEMA = (
    "MBLNR BIGINT, MJAHR INT, ZEILE INT, MATNR STRING, WERKS STRING, CHARG STRING, "
    "BWART STRING, MENGE INT, MEINS STRING, BUDAT DATE, CPUDT_TIME TIMESTAMP, "
    "LIFNR STRING, KUNNR STRING"
)


def columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def stored(spark: SparkSession, folder: Path, name: str, text: str, schema: str) -> DataFrame:
    """The text as a CSV file, read back, with its rows numbered."""
    path = folder / f"{name}.csv"
    path.write_text(text)
    return read_csv(spark, str(path), schema).withColumn(
        "_arrival", F.monotonically_increasing_id()
    )


# Batches: the stage they stop before, and the hours of work in a stage and of waiting
# for the next.
BATCHES = {"LOT-A": (12, 30, 12), "LOT-B": (12, 6, 54), "LOT-C": (3, 18, 24)}


def movements_text() -> str:
    """Two lines for each stage of each batch, then lines that must be rejected."""
    code_of = {stage: code for code, stage in reversed(goods.LIFE_CYCLE.code_to_stage.items())}
    lines = [",".join(columns(MOVEMENT_SCHEMA))]

    def line(doc: int, at: int, material: str, lot: str, code: str, amount: object, now: datetime) -> str:
        return f"{doc},2021,{at},{material},W1,{lot},{code},{amount},KG,{now:%Y-%m-%d},{now},,"

    for n, (lot, (stages, work, wait)) in enumerate(BATCHES.items(), start=1):
        now = datetime(2021, 3, 1, 6)
        for at, stage in enumerate(goods.LIFE_CYCLE.stages[:stages]):
            lines.append(line(n, 2 * at, f"MAT{n}", lot, code_of[stage], 100, now))
            now += timedelta(hours=work)
            lines.append(line(n, 2 * at + 1, f"MAT{n}", lot, code_of[stage], 40, now))
            now += timedelta(hours=wait)
    late = datetime(2021, 9, 1)
    lines += [
        line(1, 0, "MAT1", "LOT-A", "101", 5, late),  # the key of an earlier line
        line(9, 1, "", "LOT-A", "101", 5, late),
        line(9, 2, "MAT1", "", "101", 5, late),
        line(9, 3, "MAT1", "LOT-A", "none", 5, late),
        line(9, 4, "MAT1", "LOT-A", "101", -1, late),
    ]
    return "\n".join(lines) + "\n"
