"""ledgerlight — retail-week sales reporting and study-visit synchronisation
expressed as PySpark DataFrame / SQL plans.

Sub-packages:
  sources    readers for the driver tables, landed JSON pages, CSV sheets,
             literal parameter tables
  functions  column-expression helpers (calendar, blank arithmetic, text)
  operators  reusable table operators (window measures, ranks, joins,
             report unpivot, data quality, resolution, merge/watermark)
  plans      the registered queries built from the operators
  streaming  the incremental visit upsert as a Structured Streaming job
"""

__version__ = "0.1.0"
