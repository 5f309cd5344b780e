"""End-to-end plans: the batch jobs and the registered queries over the test tables."""
