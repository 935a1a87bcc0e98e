"""reviewkit: review-text preparation and analysis as Spark DataFrame jobs.

Sub-packages:

* ``sources``   - readers and writers (CSV reviews, stop lists, chunks, vocabularies)
* ``functions`` - column expressions (cleaning, labels, array helpers)
* ``operators`` - DataFrame -> DataFrame operators (tokens, vocabulary, encoding,
                  sampling, metrics, segmentation, data quality)
* ``plans``     - end-to-end compositions (word-frequency job, corpus preparation,
                  classifier training and scoring) and the query catalog
* ``streaming`` - Structured Streaming scoring
"""

__version__ = "0.1.0"
