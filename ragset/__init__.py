"""ragset: Spark jobs that build, de-duplicate and score question/answer datasets at corpus scale."""
