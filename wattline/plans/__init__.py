"""Jobs that chain the operators: training, scoring, monitoring, comparison."""
