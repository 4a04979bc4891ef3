from outcomekit.sources.tables import load_table, read_csv_table, normalise_nulls, TableMissing
from outcomekit.sources.cohort import driver_table, build_cohort, COHORT_FEATURES

__all__ = ["load_table", "read_csv_table", "normalise_nulls", "TableMissing",
           "driver_table", "build_cohort", "COHORT_FEATURES"]
