"""hearth: property appraisal and corpus preparation as plain Spark DataFrame jobs."""
