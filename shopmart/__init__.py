"""Spark-native analytics for online-marketplace data.

Layers: ``sources`` (CSV landing, publishing, export) -> ``plans.staging`` ->
``plans.intermediate`` -> ``plans.marts`` -> ``plans.analyses`` and
``plans.dashboard``.  ``operators`` holds the reusable DataFrame operators and
``functions`` the Column expressions everything else is made of.
"""
