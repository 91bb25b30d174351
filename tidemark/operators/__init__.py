"""DataFrame operators: cleaning, facts, marts, scores, rules and checks."""
