"""retentia: customer-lifecycle analytics (bronze -> silver -> gold -> churn model -> segments -> reports) on Spark."""

__version__ = "0.1.0"
