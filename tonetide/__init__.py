"""Text sentiment analytics as DataFrame operators and Spark jobs.

``sources``   typed readers, writers, resumable stages, ingest jobs
``functions`` column expressions (text cleaning, labels, flags, keys, days)
``operators`` DataFrame to DataFrame building blocks (joins, rollups, n-grams, models)
``plans``     the jobs built from them: train, score, report, post-process
``catalog``   runnable queries over the test tables, each with its SQL twin
"""
