"""Jobs composed from the operators: dimension build, bronze, silver, gold and the whole run."""
