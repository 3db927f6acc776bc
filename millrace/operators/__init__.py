"""DataFrame to DataFrame operators. No clocks inside: times and roles are arguments."""
