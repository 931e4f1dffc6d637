"""candlemill: change-data-capture trade streams to Bronze, Silver and Gold tables on Spark.

* ``sources``    readers and writers: change feeds, lake tables, relational tables
* ``functions``  column expressions shared by batch and streaming
* ``operators``  pure ``DataFrame -> DataFrame`` transforms
* ``streaming``  the continuous Bronze and Silver queries and their progress
* ``plans``      batch jobs that combine the above
"""
