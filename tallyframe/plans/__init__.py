MODULES = ["sources", "relational", "aggregates", "joins_windows", "scalars", "cleaning", "features", "statistics",
           "timeseries", "market", "evaluation", "models", "monitoring", "text", "prompts", "graph", "plotdata",
           "streaming"]
