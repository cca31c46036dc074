"""DataFrame-to-DataFrame building blocks; everything is lazy unless it says otherwise."""
