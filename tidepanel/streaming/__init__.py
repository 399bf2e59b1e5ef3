"""No streaming operators.

The workload reads complete files once and queries finished tables, so there is
no watermark, stream window or stateful operator to provide. An incremental
re-run appends a period and recomputes the affected keys with the batch
operators.
"""
