"""lakeshore: a Spark-native customer / order / campaign attribution library.

Bronze -> silver -> gold batch flows, data-quality operators, DataFrame-to-DataFrame
row changes, in-place changes of stored tables and governed views, all expressed with the
DataFrame / SQL API so that Catalyst and adaptive execution do the planning.
"""

__version__ = "0.1.0"
