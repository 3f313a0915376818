"""retenta: customer-attrition features, model training and scoring on Spark.

Every operator is a function from DataFrame(s) to a DataFrame, written with
the DataFrame / SQL API so Catalyst plans it; fitted state (imputation,
encoding, scaling, feature order) lives in small DataFrames that are joined
or broadcast, never pickled.
"""

__all__ = ["session"]
