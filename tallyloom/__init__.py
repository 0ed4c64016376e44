"""tallyloom: sales marts, a metric layer and document answers, written as Spark DataFrame jobs."""
