"""Jobs that chain the operators from stored inputs to stored results."""
