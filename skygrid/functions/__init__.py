"""skygrid.functions"""
