"""The analytics themselves: reports, panels, models, scoring and explanations."""
