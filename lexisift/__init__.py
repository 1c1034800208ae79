"""lexisift: Spark-native text-classification analytics.

Every operator is a DataFrame -> DataFrame function (or an MLlib stage) that
runs on a cluster; column names are parameters (``text_col``, ``label_col``,
``key_col``).  Sub-packages:

* ``functions`` - column expressions (cleaning, tokens, label maps, arrays)
* ``operators`` - DataFrame operators (classes, split, tfidf, models, eval)
* ``sources``   - readers and writers
* ``plans``     - end-to-end runs built from the operators
* ``streaming`` - the fitted scorer on a Structured Streaming source
"""

__version__ = "0.1.0"
