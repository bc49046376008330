"""skygrid: station time-series analytics as Spark DataFrame jobs."""
