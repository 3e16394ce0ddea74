"""rowtide: change-data-capture feeds to clean, self-describing events on Spark."""

from rowtide.contract import CellTransform, ColumnSpec, ContractError, TableContract, contract_df

__all__ = ["CellTransform", "ColumnSpec", "ContractError", "TableContract", "contract_df"]
