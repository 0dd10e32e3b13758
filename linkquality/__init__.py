"""PySpark speed-test analytics: ingest, silver, sessions, gold and serving queries.

Public entry points (all DataFrame -> DataFrame unless noted):

* ``sources.landing``: ``read_landing``, ``landing_keys``, ``read_bronze``
* ``functions.time``: ``localize``, ``utc_wallclock``, ``month_range``,
  ``month_series``, ``month_bounds``, ``default_month``, ``has_fall_back``
* ``operators.silver.clean_measurements``
* ``operators.sessions``: ``create_user_sessions``, ``flag_sessions``,
  ``session_stats``, ``enrich_sessions``, ``bucket_partials``,
  ``sessions_from_partials``
* ``operators.gold``: ``regional_metrics``, ``user_retention``,
  ``frustration_staircase``
* ``operators.serving``: filters, ``kpis``, ``rolling_mean``, roll-ups,
  ``gap_quantile``, ``gap_density``, ``dashboard`` (dict of frames)
* ``operators.stats``: ``exact_quantile``, ``correlation_matrix``,
  ``kernel_density``
* ``sinks.write_table``; ``plans.jobs``: ``ingest_months``,
  ``refresh_warehouse`` (jobs, write tables)
* ``streaming.ingest``: ``ingest_new_files``, ``ingest_and_refresh``
* ``conf``: ``build_session``, ``scale_conf``, ``scratch_root``
"""

__version__ = "0.1.0"
