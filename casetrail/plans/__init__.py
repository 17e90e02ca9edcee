"""The pipelines: staging views, wide staged rows and event-set jobs, each a function of DataFrames."""
