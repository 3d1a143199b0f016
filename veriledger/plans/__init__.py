"""Jobs built from the operators: landing, entity runs, the job list and the acceptance queries."""
