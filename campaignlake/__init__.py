"""Campaign analytics as Spark jobs: quality, segments, tests, models, evaluation."""
