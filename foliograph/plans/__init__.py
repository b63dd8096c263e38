"""Session helpers and the plan shapes the operators share."""
