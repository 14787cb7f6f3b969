"""jobtide.functions"""
