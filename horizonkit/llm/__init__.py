"""Training-data pipeline operators on Spark DataFrames.

One module per operator (packing, chat formatting, language ID, near-dup
detection, nearest neighbours, quality classification, language-model scoring,
decontamination, line dedup, binary token output), shared array helpers in
``text_arrays`` and ``tokens``, shared Spark helpers in ``tables`` and
``components``, and the registered queries in ``queries``. Nothing else in the
library imports this subpackage.
"""
