"""marginlib: product-profitability analytics on Spark.

Raw order / catalog / return records (typed key columns plus the full JSON
payload) are landed with latest-wins upserts, flattened, costed per order
line and rolled up into profit tables per SKU, SKU x month, SKU x channel,
a cost watch and a cleaned returns table, plus data-quality checks.

Layout:
  functions/  Column-expression helpers (exact decimals, JSON coercion)
  sources/    seed tables, landing of JSON payloads, test-data fixtures
  operators/  staging, costing, marts, returns matching, upsert, checks
  plans/      the end-to-end job and the registered query set
  streaming/  incremental latest-wins landing with Structured Streaming
"""

__version__ = "0.1.0"
