from tallyloom.catalog import audit, bibliometrics, columns, jobs, layouts, quality, relational, storage  # noqa: F401
