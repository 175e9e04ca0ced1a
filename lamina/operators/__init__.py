"""DataFrame → DataFrame operators: identity resolution, page views, URLs."""
