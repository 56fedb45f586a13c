"""Reporting views built from the operators, and the driver query catalogue.

Views (each a function over input DataFrames):
  rental_invoices.rental_invoices           V1 rental service invoices
  receipts.receipts                         V2 cash receipts
  assets.assets                             V3 fixed-asset register
  used_sales.used_sales                     V4 used-equipment sales and returns
  contract_items.contract_items             V5 contract items (+ refresh_contract_items snapshot)
  contract_items.contract_item_status       V6 active / inactive contract items
  billing_reconciliation.billing_reconciliation  V7 contract line / order / invoice reconciliation
  priced_flow.priced_flow                   V8 priced billing flow

``plans.catalog`` registers the driver queries (one per operator key) with
their DuckDB oracle SQL; ``plans.registry`` holds the registry.
"""
