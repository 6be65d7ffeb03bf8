"""Training-data operators: each module holds one operator; ``catalog`` registers their queries."""
