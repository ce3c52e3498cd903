"""cohortlens: customer-lifecycle analytics (fee ledger, deal fact, retention,
churn and cohort KPIs) expressed as Spark DataFrame plans.

Every product is a function ``DataFrame(s) + parameters -> DataFrame``; nothing
is collected to the driver and no Python UDF runs in a hot path.
"""

__version__ = "0.2.0"
