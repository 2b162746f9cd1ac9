"""What a plan will cost: size estimates, broadcast checks, plan text."""
