"""Goods movements: the intake of document lines and the stage model behind lead times."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from siltgate.contracts import CodeTable, Intake, Rule, StageModel
from siltgate.functions import predicates as bad
from siltgate.functions import sql
from siltgate.functions.timestamps import first_timestamp
from siltgate.operators import process

# The stages of a batch's life in order, and the movement codes that
# mark each stage.
LIFE_CYCLE = StageModel(
    stages=(
        "supplier",
        "raw_material_procurement",
        "inbound_logistics",
        "raw_material_receipt",
        "quality_inspection_and_release",
        "manufacturing",
        "packaging",
        "finished_goods",
        "warehouse",
        "distribution_center",
        "customer_shipment",
        "customer",
    ),
    code_to_stage={
        "101": "raw_material_receipt",
        "103": "raw_material_receipt",
        "105": "quality_inspection_and_release",
        "321": "quality_inspection_and_release",
        "322": "quality_inspection_and_release",
        "261": "manufacturing",
        "262": "manufacturing",
        "101F": "manufacturing",
        "531": "manufacturing",
        "311": "warehouse",
        "313": "warehouse",
        "315": "warehouse",
        "601": "customer_shipment",
        "602": "customer_shipment",
        "641": "distribution_center",
        "643": "distribution_center",
        "647": "distribution_center",
        "Z07": "distribution_center",
        "101S": "supplier",
        "541": "raw_material_procurement",
        "542": "raw_material_procurement",
        "561": "inbound_logistics",
        "562": "inbound_logistics",
        "309": "packaging",
        "501": "finished_goods",
        "Z01": "supplier",
        "Z02": "raw_material_procurement",
        "Z03": "inbound_logistics",
        "Z04": "packaging",
        "Z05": "finished_goods",
        "Z06": "customer",
    },
)


@dataclass(frozen=True)
class MovementColumns:
    """The roles of a movement table's columns, and the reason names of its rejections.
    The defaults are fixed values: column names as an ERP system exports them."""

    key: tuple[str, ...] = ("MBLNR", "MJAHR", "ZEILE")
    material: str = "MATNR"
    plant: str = "WERKS"
    batch: str = "CHARG"
    code: str = "BWART"
    quantity: str = "MENGE"
    unit: str = "MEINS"
    entry_time: str = "CPUDT_TIME"
    posting_date: str = "BUDAT"
    vendor: str = "LIFNR"
    customer: str = "KUNNR"
    duplicate_reason: str = "duplicate_mseg_key"
    missing_reason: str = "missing_matnr_charg_bwart_or_werks"
    unmapped_reason: str = "unmapped_bwart"
    quantity_reason: str = "invalid_menge"
    time_reason: str = "invalid_timestamp"

    @property
    def attributes(self) -> Mapping[str, str]:
        return {
            "plant": self.plant,
            "material": self.material,
            "uom": self.unit,
            "vendor": self.vendor,
            "customer": self.customer,
        }


SAP_COLUMNS = MovementColumns()


def movement_intake(
    bronze_columns: Sequence[str],
    columns: MovementColumns = SAP_COLUMNS,
    model: StageModel = LIFE_CYCLE,
    order_by: Sequence[str] = ("_arrival",),
    codes: CodeTable | None = None,
) -> Intake:
    """The intake of movement lines. Stages come from the model's map, or with ``codes``
    from a code table, whose values must name the new column ``stage``."""
    in_map = ("stage", sql.map_value(model.code_to_stage, sql.name(columns.code)))
    required = (columns.material, columns.batch, columns.code, columns.plant)
    return Intake(
        name="movements",
        key=columns.key,
        order_by=tuple(order_by),
        duplicate_reason=columns.duplicate_reason,
        codes=codes,
        derived=(
            *([] if codes else [in_map]),
            (
                "event_ts",
                lambda schema: first_timestamp(
                    schema, columns.entry_time, columns.posting_date
                ),
            ),
        ),
        rules=(
            Rule(columns.missing_reason, bad.any_blank(required)),
            Rule(columns.unmapped_reason, "stage IS NULL"),
            Rule(columns.quantity_reason, bad.negative_or_missing(columns.quantity)),
            Rule(columns.time_reason, "event_ts IS NULL"),
        ),
        bronze_columns=tuple(bronze_columns),
        silver_columns=(*bronze_columns, "stage", "event_ts"),
    )


def movement_stage_events(
    silver: DataFrame,
    columns: MovementColumns = SAP_COLUMNS,
    model: StageModel = LIFE_CYCLE,
) -> DataFrame:
    return process.stage_events(
        silver,
        model,
        batch=columns.batch,
        quantity=columns.quantity,
        attributes=columns.attributes,
        order_by=("event_ts", *columns.key),
    )
