"""Contracts of the job outputs as the downstream store expects them.

Fixed values (must equal the published contracts): column names in order
with their types. Names keep the contracts' spelling ('.' where the header
had a space or parenthesis), so ``contract_diff`` against a job's output
shows the known naming differences.
"""

from __future__ import annotations


def _contract(name: str, spec: str) -> dict:
    cols = []
    for item in spec.split(","):
        col, typ = item.strip().rsplit(" ", 1)
        cols.append({"name": col, "type": typ})
    return {"name": name, "columns": cols, "projection": [c["name"] for c in cols]}


# Output contracts (name, ordered "column TYPE" list).
POS = _contract("POS", "X INTEGER, POS STRING, DOS STRING, Period INTEGER, Sort_Index INTEGER")
COSI_EMBARK = _contract(
    "cosi_embark",
    "ASSESSMENTNUMBER INTEGER, CLASS_OF_SUPPLY STRING, COS_TYPE STRING, REGION STRING, "
    "REGION_MEF_LEAD STRING, LOCATION_ID INTEGER, LOCATION_NAME STRING, UI STRING, POS STRING, "
    "QTY DECIMAL, PALLETS DECIMAL, UNITS_PALLET_TOT_CUFT DECIMAL, UNITS_PALLET_TOT_TEUS DECIMAL, "
    "UNITS_PALLET_TOT_WT.LBS. DECIMAL, TOTAL_COST DECIMAL")
COSI_WATER_EMBARK = _contract(
    "cosi_water_embark",
    "CLASS_OF_SUPPLY STRING, REGION STRING, LOCATION_NAME STRING, REGION_MEF_LEAD STRING, "
    "COS_TYPE STRING, UI STRING, POS STRING, QTY DECIMAL, CUFT DECIMAL, SQFT INTEGER, TEUS DECIMAL, "
    "WEIGHT_LBS DECIMAL, TOTAL_COST DECIMAL")
COSVI_EMBARK = _contract(
    "cosvi_embark",
    "ASSESSMENTNUMBER INTEGER, CLASS_OF_SUPPLY STRING, REGION STRING, LOCATION_ID INTEGER, "
    "LOCATION_NAME STRING, REGION_MEF_LEAD STRING, COS_TYPE STRING, POS STRING, UI STRING, QTY DECIMAL, "
    "PALLETS DECIMAL, CUFT DECIMAL, TEUS DECIMAL, WEIGHT_LBS DECIMAL, TOTAL_COST DECIMAL")
AGGREGATED_EMBARK = _contract(
    "aggregated_embark",
    "CLASS_OF_SUPPLY STRING, REGION STRING, LOCATION_NAME STRING, POS STRING, CUFT DECIMAL, "
    "SQFT DECIMAL, TEUS DECIMAL, WEIGHT_LBS DECIMAL, TOTAL_COST DECIMAL")

OUTPUT_CONTRACTS = {c["name"]: c for c in (POS, COSI_EMBARK, COSI_WATER_EMBARK, COSVI_EMBARK,
                                            AGGREGATED_EMBARK)}
