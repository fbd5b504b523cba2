"""Job plans: each registered function takes (spark, sf_dir) and returns a DataFrame.

retail           the 26 retail exercises on the driver tables (q01..q26)
incremental      guarded / window ODS loads, high-water marks, key-based merges
purchase_orders  scalar-or-array JSON into new stock items with continued keys
medallion        raw documents -> bronze -> silver / quarantine / lookups -> repair
warehouse        dimension and fact builds, ODS -> integration flow
pipelines        config-driven table loop, typed ODS copies, deletion requests
misc             chunked JSON split, text cleaning, surrogate keys, profiles
oracles          the independent DuckDB SQL for every registered job
registry         job name -> function
"""
