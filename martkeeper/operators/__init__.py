"""DataFrame operators: conforming, milestones, periods, roll-ups, metrics, governance, grants."""
