"""Daily-partitioned market-data warehouse operators, written as Spark DataFrame plans.

Every public function takes DataFrames (and, where a run date matters, ``ds``) and
returns a DataFrame.  Only ``sources`` and ``sinks`` touch storage.

``ds=None`` means "every day in the inputs": the day is then part of the join and
grouping keys, so a whole history is computed by one job.  A given ``ds`` first
filters the inputs on ``p_date``, which prunes partitions of a day-partitioned table.
"""
