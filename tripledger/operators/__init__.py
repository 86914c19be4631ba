"""DataFrame operators: time rules, classification, spine, contributions, file shaping."""
