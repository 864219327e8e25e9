from vaultwright.sources.history import SatelliteStore
from vaultwright.sources.schemas import create_statement, empty_table, target_schema
from vaultwright.sources.sequences import Sequence
from vaultwright.sources.tables import CatalogTable, ParquetTable
from vaultwright.staging import shared_folder, stage, staged_for_now

__all__ = [
    "CatalogTable",
    "ParquetTable",
    "SatelliteStore",
    "Sequence",
    "create_statement",
    "empty_table",
    "shared_folder",
    "stage",
    "staged_for_now",
    "target_schema",
]
