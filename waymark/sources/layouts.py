"""Record layouts of the raw files and the tables they load into."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Raw files to pick from a batch directory start with this text (fixed value).
RAW_PREFIX = "AddressBasePremium"

# ---------------------------------------------------------------------------
# Record identifier, output file, landing table, fields in file
# order with type. Loads are positional, so the order is part of the format.
# ---------------------------------------------------------------------------
_LAYOUT_TEXT = """
10 ID10_Header_Records.csv -
  record_identifier string, custodian_name string, local_custodian_name string,
  process_date string, volume_number string, entry_date string,
  time_stamp string, version string, file_type string
11 ID11_Street_Records.csv abp_street
  record_identifier short, change_type string(1), pro_order long, usrn int,
  record_type short, swa_org_ref_naming short, state short, state_date date,
  street_surface short, street_classification short, version short,
  street_start_date date, street_end_date date, last_update_date date,
  record_entry_date date, street_start_x double, street_start_y double,
  street_start_lat double, street_start_long double, street_end_x double,
  street_end_y double, street_end_lat double, street_end_long double,
  street_tolerance short
15 ID15_StreetDesc_Records.csv abp_street_descriptor
  record_identifier short, change_type string(1), pro_order long, usrn int,
  street_description string(110), locality string(50), town_name string(30),
  administrative_area string(30), language string(3), start_date date,
  end_date date, last_update_date date, entry_date date
21 ID21_BLPU_Records.csv abp_blpu
  record_identifier short, change_type string(1), pro_order long, uprn long,
  logical_status short, blpu_state short, blpu_state_date date,
  parent_uprn long, x_coordinate double, y_coordinate double, latitude double,
  longitude double, rpc short, local_custodian_code short, country string(1),
  start_date date, end_date date, last_update_date date, entry_date date,
  addressbase_postal string(1), postcode_locator string(8),
  multi_occ_count short
23 ID23_XREF_Records.csv abp_crossref
  record_identifier short, change_type string(1), pro_order long, uprn long,
  xref_key string(14), cross_reference string(50), version short,
  source string(6), start_date date, end_date date, last_update_date date,
  entry_date date
24 ID24_LPI_Records.csv abp_lpi
  record_identifier short, change_type string(1), pro_order long, uprn long,
  lpi_key string(14), language string(3), logical_status short,
  start_date date, end_date date, last_update_date date, entry_date date,
  sao_start_number short, sao_start_suffix string(2), sao_end_number short,
  sao_end_suffix string(2), sao_text string(90), pao_start_number short,
  pao_start_suffix string(2), pao_end_number short, pao_end_suffix string(2),
  pao_text string(90), usrn int, usrn_match_indicator string(1),
  area_name string(50), level string(30), official_flag string(1)
28 ID28_DPA_Records.csv abp_delivery_point
  record_identifier short, change_type string(1), pro_order long, uprn long,
  udprn long, organisation_name string(60), department_name string(60),
  sub_building_name string(30), building_name string(80),
  building_number short, dependent_thoroughfare string(80),
  thoroughfare string(80), double_dependent_locality string(50),
  dependent_locality string(50), post_town string(30), postcode string(8),
  postcode_type string(1), delivery_point_suffix string(2),
  welsh_dependent_thoroughfare string(80), welsh_thoroughfare string(80),
  welsh_double_dependent_locality string(50),
  welsh_dependent_locality string(50), welsh_post_town string(30),
  po_box_number string(6), process_date date, start_date date, end_date date,
  last_update_date date, entry_date date
29 ID29_Metadata_Records.csv -
  record_identifier string, gaz_name string, gaz_scope string,
  ter_of_use string, linked_data string, gaz_owner string, ngaz_freq string,
  custodian_name string, custodian_uprn string, local_custodian_code string,
  co_ord_system string, co_ord_unit string, meta_date string,
  class_scheme string, gaz_date string, language string, character_set string
30 ID30_Successor_Records.csv abp_successor
  record_identifier short, change_type string(1), pro_order long, uprn long,
  succ_key string(14), start_date date, end_date date, last_update_date date,
  entry_date date, successor long
31 ID31_Org_Records.csv abp_organisation
  record_identifier short, change_type string(1), pro_order long, uprn long,
  org_key string(14), organisation string(100), legal_name string(60),
  start_date date, end_date date, last_update_date date, entry_date date
32 ID32_Class_Records.csv abp_classification
  record_identifier short, change_type string(1), pro_order long, uprn long,
  class_key string(14), classification_code string(6), class_scheme string(60),
  scheme_version double, start_date date, end_date date,
  last_update_date date, entry_date date
99 ID99_Trailer_Records.csv -
  record_identifier string, next_volume_number string, record_count string,
  entry_date string, time_stamp string
"""

# Header names that are not the upper-cased column name (fixed values).
_HEADER_NAMES = {
    ("15", "locality"): "LOCALITY_NAME",
    ("15", "administrative_area"): "ADMINSTRATIVE_AREA",
}
# ---------------------------------------------------------------------------

_SPARK_TYPES = {
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "string": T.StringType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    width: int | None

    @property
    def ddl_type(self) -> str:
        if self.kind == "string":
            return f"VARCHAR({self.width})" if self.width else "STRING"
        return _SPARK_TYPES[self.kind].simpleString().upper()


@dataclass(frozen=True)
class Layout:
    record_type: str
    file_name: str
    table: str | None
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, _SPARK_TYPES[f.kind]) for f in self.fields]
        )

    @property
    def widths(self) -> dict[str, int]:
        return {f.name: f.width for f in self.fields if f.width}

    @property
    def header_line(self) -> str:
        return ",".join(
            _HEADER_NAMES.get((self.record_type, name), name.upper())
            for name in self.columns
        )


def _read_layouts(text: str) -> dict[str, Layout]:
    layouts = {}
    for block in re.split(r"\n(?=\d\d )", text.strip()):
        head, body = block.split("\n", 1)
        record_type, file_name, table = head.split()
        fields = []
        for item in body.split(","):
            name, kind, width = re.fullmatch(
                r"(\w+) (\w+)(?:\((\d+)\))?", item.strip()
            ).groups()
            fields.append(Field(name, kind, int(width) if width else None))
        layouts[record_type] = Layout(
            record_type, file_name, None if table == "-" else table, tuple(fields)
        )
    return layouts


LAYOUTS = _read_layouts(_LAYOUT_TEXT)
RECORD_TYPES = tuple(LAYOUTS)
TABLES = {layout.table: layout for layout in LAYOUTS.values() if layout.table}
TABLE_FILES = {table: layout.file_name for table, layout in TABLES.items()}
