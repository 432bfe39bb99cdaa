"""Multi-step SQL jobs and the repurchase analysis."""
