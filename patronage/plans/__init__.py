"""The analytic jobs, from staging tables to briefs."""
