"""featlab: feature engineering and model preparation as Spark jobs.

Two shapes only: ``Column -> Column`` functions (``featlab.functions``) and
DataFrame operators, most as ``fit(df) -> model`` / ``model.transform(df)``
(``featlab.operators``). Scans and sinks live in ``featlab.sources``, the
registered queries in ``featlab.plans``.
"""

__version__ = "0.1.0"
