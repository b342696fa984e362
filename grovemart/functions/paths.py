"""Reading and writing the landing path contract year=/month=/day=/state/name.csv."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from grovemart.schema import FILE_SUFFIX, STATE_DOWNLOADED

# A delivery is <name>.csv, either one file or a folder of part files.
DELIVERY_PATTERN = (
    r"^(.*/year=([0-9]{4})/month=([0-9]{1,2})/day=([0-9]{1,2})/([^/]+)/([^/]+[.]csv))(/[^/]+)?$"
)


def decoded_path(path: Column) -> Column:
    """A file's path as it is written; `_metadata` has it URL-encoded, but for plus signs."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def delivery_parts(path: Column) -> dict[str, Column]:
    """Delivery folder, date, state and dataset of a file path; '' or NULL when off-contract."""

    def part(group: int) -> Column:
        return F.regexp_extract(path, DELIVERY_PATTERN, group)

    return {
        "delivery": part(1),
        "snapshot_date": F.try_to_date(F.concat_ws("-", part(2), part(3), part(4)), "yyyy-M-d"),
        "state": part(5),
        "dataset": dataset_name(part(6)),
    }


def dataset_name(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"[.]csv$", "")


def delivery_path(
    root: str, delivered_on: date, dataset: str, state: str = STATE_DOWNLOADED
) -> str:
    day = f"year={delivered_on:%Y}/month={delivered_on:%m}/day={delivered_on:%d}"
    return f"{root}/{day}/{state}/{dataset}{FILE_SUFFIX}"
