"""jobtide.sources"""
