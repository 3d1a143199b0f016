"""The rule catalogue: entities, code lists and the rule set of every job."""
