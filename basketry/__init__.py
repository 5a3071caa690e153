"""basketry — retail analytics and modelling operators on Spark DataFrames.

Every public operator takes DataFrames (plus column-name parameters) and
returns a lazy DataFrame; nothing is collected to the driver except bounded
scalars (bucket edges, one-row totals) that Catalyst turns into scalar
subqueries.
"""

__version__ = "0.1.0"
